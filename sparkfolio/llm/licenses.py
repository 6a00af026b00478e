"""Licence notices in texts, retrieved by MinHash bands and verified by exact containment (operator 4).

Shingles of five words are cut into overlapping windows; for templates of s shingles, windows of 2c at a stride of c
with c the power of two at or above s, so that an occurrence lies whole in one of them. A window and a template in it
share at least a known part of their union, and the number of one-row bands is set so that the odds of missing it
are below ``MISS``. Everything is DataFrame expressions.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh, table, written

#: Opening statements of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "GPL-3.0": "licensed under the GNU General Public License, version 3",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "AGPL": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "licensed under a Creative Commons Attribution 4.0 International License",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}
WORD = r"[\p{L}\p{N}]++"
SHINGLE, PART, MISS = 5, 0.8, 1e-4
#: Templates are looked up on the driver; a table of more of them, or of more characters, is an error.
MOST, CHARACTERS = 10_000, 64 << 20
#: A window's share of common shingles when a template is contained: 0.8 * (c / 2) in at most 2c + 0.1c.
BANDS = math.ceil(math.log(MISS) / math.log(1 - PART * 0.5 / (2 + (1 - PART) * 0.5)))


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _size(words: list[str], shingle: int) -> int:
    return len({tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))})


def _class(size: int) -> int:
    return 1 << math.ceil(math.log2(size))


def _signs(words: list[str], shingle: int, part: float) -> set[str]:
    """Words of which a text that contains the part of the template must hold one: of each shingle among as many as cannot all be missing, the longest."""
    grams = list(dict.fromkeys(tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))))
    need = len(grams) - math.ceil(part * len(grams)) + 1
    by_word: dict[str, int] = {}
    for g in grams:
        for w in set(g):
            by_word[w] = by_word.get(w, 0) + 1
    signs: set[str] = set()
    for g in sorted(grams, key=lambda g: -max(len(w) for w in g))[:need]:
        if not signs & set(g):
            signs.add(max(g, key=lambda w: (len(w), by_word[w])))
    return signs


def shingles(text: Column, shingle: int = SHINGLE) -> Column:
    """Hashes of a lower-cased text's shingles, in order; fewer words are one; none without words."""

    def of(words: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - shingle, F.lit(0))), lambda i: F.xxhash64(F.array_join(F.slice(words, i + 1, shingle), " ")))
        return F.when(F.size(words) > 0, each).otherwise(F.array().cast("array<bigint>"))

    # bound as a variable, the words are found once, not for each shingle
    return F.get(F.transform(F.array(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))), of), F.lit(0))


def _least(hashes: Column) -> Column:
    """For each of BANDS seeds, the least of the hashes hashed anew with it: any hash is as likely to be that one, in each band for itself."""

    def one(seed: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(seed))))

    return F.array(*[one(x) for x in range(BANDS)])


def given(templates: dict[str, str] | DataFrame) -> dict[str, str]:
    """Templates by name, from a mapping or a table (license, text); of names with several texts each is kept, as name#2 and so on. Null ones are none."""
    if isinstance(templates, dict):
        return templates
    rows = templates.where("license is not null and text is not null").select("license", F.col("text").cast("string").alias("text"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("c")).first()
    if size["n"] > MOST or size["c"] > CHARACTERS:
        raise ValueError(f"{size['n']} templates of {size['c']} characters are more than {MOST} of {CHARACTERS}")
    out: dict[str, str] = {}
    for r in rows.distinct().orderBy("license", "text").collect():
        k = next(k for k in range(1, MOST + 2) if (f"{r['license']}#{k}" if k > 1 else r["license"]) not in out)
        out[f"{r['license']}#{k}" if k > 1 else r["license"]] = r["text"]
    return out


def scan(docs: DataFrame, templates: dict[str, str] | DataFrame = TEMPLATES, part: float = PART) -> DataFrame:
    """(mark, license, at) of every template contained in a window of a text of ``docs``.

    ``templates`` may be whole licence texts, as a mapping or a table (license, text).
    mark is ``row_mark`` of the document, at the first word of the window. A template is contained if the window
    holds at least ``part`` of its distinct five-word shingles; a template or text of fewer words is one shingle. Null
    and empty texts contain nothing. Equal rows share a mark. Other columns than doc_id and text are not read.
    """
    spark, templates = docs.sparkSession, given(templates)
    known = {k: w for k, t in templates.items() if (w := template_words(t))}
    rows = [(k, _class(_size(w, SHINGLE)), " ".join(w)) for k, w in known.items()]
    own = spark.createDataFrame(rows, "license string, width int, words string").withColumn("shingles", F.array_distinct(shingles(F.col("words"))))
    bands = own.select("license", F.col("width").alias("w"), "shingles", F.posexplode(_least(F.col("shingles"))).alias("b", "value"))

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    low = F.lower(text)
    widths = sorted({_class(_size(w, SHINGLE)) for w in known.values()})

    def may(width: int) -> Column:
        out = F.lit(False)
        for sign in sorted({s for w in known.values() if _class(_size(w, SHINGLE)) == width for s in _signs(w, SHINGLE, part)}):
            out = out | F.contains("low", F.lit(sign))
        return out

    asked = docs.select(row_mark(docs).alias("mark"), text.alias("text"), low.alias("low"))
    asked = asked.select("mark", "text", F.filter(F.array(*[F.when(may(w), F.lit(w)) for w in widths]), lambda w: w.isNotNull()).alias("widths")).where(F.size("widths") > 0).distinct()
    asked = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "mark")  # few bytes, much work
    cut = written(asked.select("mark", "widths", shingles(F.col("text")).alias("all")), "license-candidates")
    windows = cut.select("mark", "all", F.explode("widths").alias("width"))
    windows = windows.select("mark", "width", F.explode_outer(F.expr("transform(sequence(0, greatest(size(all) - width - 1, 0), width), i -> struct(i AS at, slice(all, i + 1, 2 * width) AS part))")).alias("x"))
    windows = windows.select("mark", "width", F.col("x.at").alias("at"), F.array_distinct("x.part").alias("part"))
    probes = windows.select("mark", "width", "at", "part", F.posexplode_outer(_least(F.col("part"))).alias("band", "least"))
    met = probes.join(F.broadcast(bands), (F.col("width") == F.col("w")) & (F.col("band") == F.col("b")) & (F.col("least") == F.col("value")))  # templates x bands rows
    held = F.size(F.array_intersect("part", "shingles")) >= F.size("shingles") * part
    return met.where(held).select("mark", "license", "at").distinct()


def row_mark(docs: DataFrame) -> Column:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return F.xxhash64(docs["doc_id"].cast("string"), text, F.crc32(text.cast("binary")))


def licensed(docs: DataFrame, templates: dict[str, str] | DataFrame = TEMPLATES, part: float = PART) -> DataFrame:
    """The rows and columns of ``docs`` with ``licenses``, the sorted names of the templates found (none: empty)."""
    mark, names = fresh(docs, "mark", "licenses")
    found = scan(docs, templates, part).groupBy(F.col("mark").alias(mark)).agg(F.array_sort(F.collect_set("license")).alias(names))  # at most all templates
    return docs.withColumn(mark, row_mark(docs)).join(found, mark, "left").select(*docs.columns, F.coalesce(names, F.array().cast("array<string>")).alias(names))


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    """The whole of ``documents``: doc_id, n_licenses, licenses (comma-joined)."""
    found = licensed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join("licenses", ",").alias("licenses"))
