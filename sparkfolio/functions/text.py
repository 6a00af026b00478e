"""Column expressions on text: white space, sentences, headings, identifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it, with the four separators that Java leaves out.
SPACE = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def sentences(text: Column) -> Column:
    """Array of the non-blank sentences of a text: cut at white space after ``.``, ``!`` or ``?``.

    The text is stripped once as a whole; inner sentences then have no white space around them.
    """
    return F.filter(F.split(strip(text), rf"(?U)(?<=[.!?]){SPACE}+"), lambda s: s != "")


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


def slug(title: Column) -> Column:
    """Lower case, everything but a-z and 0-9 as single underscores, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(title), "[^a-z0-9]+", "_"), "^_+|_+$", "")


#: Parts of headings and the section types they stand for; the first that occurs counts.
SECTION_RULES = (
    ("abstract", ("abstract",)),
    ("introduction", ("introduction", "background")),
    ("methods", ("method", "material", "experimental", "procedure")),
    ("results", ("result", "finding")),
    ("discussion", ("discussion",)),
    ("conclusion", ("conclusion", "summary")),
    ("references", ("reference", "bibliography")),
    ("acknowledgments", ("acknowledgment", "acknowledgement")),
    ("appendix", ("appendix", "supplement")),
)
OTHER_SECTION = "body_section"


def section_type(title: Column) -> Column:
    low = F.lower(title)
    out = None
    for kind, parts in SECTION_RULES:
        holds = reduce(lambda a, b: a | b, [F.contains(low, F.lit(p)) for p in parts])
        out = F.when(holds, kind) if out is None else out.when(holds, kind)
    return out.otherwise(OTHER_SECTION)


def last_segment(path: Column) -> Column:
    """What follows the last ``/``."""
    return F.element_at(F.split(path, "/"), -1)


def bare_doi(doi: Column) -> Column:
    """Without what precedes the last ``doi.org/``; empty is null."""
    return F.nullif(F.when(F.contains(doi, F.lit("doi.org/")), F.element_at(F.split(doi, r"doi\.org/"), -1)).otherwise(doi), F.lit(""))


def host(url: Column) -> Column:
    """The network location of a URL, with user and port; null if it has none or cannot be parsed."""
    return F.try_parse_url(url, F.lit("AUTHORITY"))


#: Fixed value: the URL namespace of RFC 4122.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """Version 5 UUID of a name (RFC 4122)."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), 1, 4)
    nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant.substr(nibble, F.lit(1)), F.substring(h, 18, 3)), F.substring(h, 21, 12))


def point_id(paper_id: Column, section: Column, index: Column) -> Column:
    return uuid5(F.concat_ws(":", paper_id.cast("string"), section.cast("string"), index.cast("string")))


def query_sentence(sentence: Column) -> Column:
    """Whether a sentence can serve as a query: 40 to 200 characters, no citation, formula or link."""
    s = strip(sentence)
    odd = s.rlike(r"(?U)\[\d+\]") | s.rlike("[{}=]") | F.contains(s, F.lit("http"))
    return F.length(s).between(40, 200) & ~odd


def progress_bar(count: Column) -> Column:
    return F.repeat(F.lit("#"), F.least((count / 100).cast("int"), F.lit(50)))
