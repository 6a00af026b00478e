from __future__ import annotations

import re
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkfolio.functions import text as t
from sparkfolio.operators.chunk import chunk


def values(spark, f, *inputs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in rows.select(f(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]


def test_strip_and_sentences(spark):
    odd = ["  a ", "\n a　\x1c", "", "a b", "\x85x "]
    assert values(spark, t.strip, *odd) == [x.strip() for x in odd]
    cases = ["A. B! C? D", "F.G is one.", "A. B.", "A.\x1cB", " \n ", "Hm... so. "]
    assert values(spark, t.sentences, *cases) == [[s.strip() for s in re.split(r"(?<=[.!?])\s+", c) if s.strip()] for c in cases]


@pytest.mark.parametrize(
    ("title", "kind"),
    [("Background", "introduction"), ("Materials and Methods", "methods"), ("Results and Discussion", "results"), ("Discussion", "discussion"), ("Bibliography", "references"), ("Summary", "conclusion"), ("Supplementary methods", "methods"), ("Supplementary data", "appendix"), ("Acknowledgements", "acknowledgments"), ("Related work", "body_section"), ("1 Intro", "body_section")],
)
def test_section_type(spark, title, kind):
    assert values(spark, t.section_type, title) == [kind]


def test_slug_doi_host(spark):
    assert values(spark, t.slug, "1 Introduction", " A--B ", "方法", "__x__") == ["1_introduction", "a_b", "", "x"]
    assert values(spark, t.bare_doi, "https://doi.org/10.1/x", "10.2/y", "", None, "doi.org/doi.org/", "http://DOI.org/z") == ["10.1/x", "10.2/y", None, None, None, "http://DOI.org/z"]
    assert values(spark, t.last_segment, "https://x.org/W1", "https://x.org/", "W2") == ["W1", "", "W2"]
    assert values(spark, t.host, "http://u@h.org:80/a", "https://x.y/z?q", None) == ["u@h.org:80", "x.y", None]


def test_uuid5(spark):
    names = ["W1:abstract:0", "", "é:x:12", "a" * 500]
    assert values(spark, t.uuid5, *names) == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]


def test_query_sentence(spark):
    base = "x" * 40
    cases = {"x" * 39: False, base: True, "x" * 200: True, "x" * 201: False, base + "[12]": False, base + "{": False, base + "=": False, base + "http": False, base + "HTTP": True, base + "[a]": True}
    assert values(spark, t.query_sentence, *cases) == list(cases.values())


def test_progress_bar(spark):
    rows = spark.createDataFrame([(0,), (99,), (100,), (123456,)], "n long")
    assert [len(r[0]) for r in rows.orderBy("n").select(t.progress_bar(F.col("n"))).collect()] == [0, 0, 1, 50]


def plain_chunks(text: str, most: int) -> list[str]:
    out, held = [], []
    for s in (s.strip() for s in re.split(r"(?<=[.!?])\s+", text.strip()) if s.strip()):
        if len(s) > most:
            out += [" ".join(held)] * bool(held) + [s]
            held = []
        elif held and len(" ".join(held)) + 1 + len(s) > most:
            out.append(" ".join(held))
            held = [s]
        elif not held and len(s) + 1 > most:
            held = [s]
        else:
            held.append(s)
    return out + [" ".join(held)] * bool(held)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab.?! \n é", max_size=120), min_size=1, max_size=30))
def test_chunks(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, x string")
    got: dict = {}
    for r in chunk(rows, ["id"], "x", 20).collect():
        got.setdefault(r.id, []).append((r.chunk_index, r.chunk_text, r.total_chunks, r.chunk_len))
    for i, x in enumerate(texts):
        want = plain_chunks(x, 20)
        assert sorted(got.get(i, [])) == [(k, c, len(want), len(c)) for k, c in enumerate(want)]


def test_chunk_examples(spark):
    cases = {"Aaaa bbb. Dd.": ["Aaaa bbb. Dd."], "Aaaa bbb. " + "C" * 25 + ". Dd.": ["Aaaa bbb.", "C" * 25 + ".", "Dd."], "1234567890. 12345678.": ["1234567890.", "12345678."], "1234567890. 1234567.": ["1234567890. 1234567."], "A. B.": ["A. B."], " \n ": []}
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "id int, x string")
    got = chunk(rows, ["id"], "x", 20).orderBy("id", "chunk_index").collect()
    for i, want in enumerate(cases.values()):
        assert [r.chunk_text for r in got if r.id == i] == want
