"""The pipeline's stages against what their operators say of the same rows."""

from __future__ import annotations

from collections import Counter

import pytest

pytest.importorskip("corpus_pipeline")

import corpus_pipeline  # noqa: E402

from sparkfolio.llm import mixing  # noqa: E402
from sparkfolio.llm.shared import written  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        kept.append([r[0] for r in docs.select("doc_id").collect()])
        if name != "sharding":
            assert docs.columns == columns
    quality, near, clean, mixed, shards = kept
    assert set(near) <= set(quality) and set(clean) <= set(near) and set(mixed) <= set(clean)
    assert len(set(near)) == len(near) and max(mixed.count(i) for i in mixed) <= 2
    assert sorted(shards) == sorted(mixed)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "shard", "shard_rows", "version"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_near_duplicates_leave_one_row_a_group(spark):
    def words(k):
        return " ".join(f"{k}x{i}" for i in range(60))

    rows = [(5, words("a")), (5, words("a")), (9, words("a")), (None, words("a")), (None, words("b")), (None, words("b")), (None, words("b") + " end"), (7, words("c")), (7, words("d")), (8, None), (8, None), (None, ""), (None, ""), (3, "")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, row string").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, (r.text or "")[:2]) for r in got.collect()), key=str)
    assert kept == sorted([(5, "ax"), (None, "bx"), (7, "cx"), (7, "dx"), (8, ""), (None, ""), (3, "")], key=str)


def test_source_mix_takes_equal_rows_as_planned_and_places_repeats(spark):
    rows = [(1, "same " * 10, "b")] * 31 + [(i, f"v{i} " * 10, "a") for i in range(100, 110)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    plan = mixing.takes(docs)
    got = [r.doc_id for r in corpus_pipeline.source_mix(spark, docs, SF).collect()]
    assert Counter(got) == Counter(r.doc_id for r in plan.collect())
    assert 31 < got.count(1) < 62
    a = [k for k, i in enumerate(got) if i >= 100]
    assert len(a) == 20 and sorted(got[k] for k in a[:10]) == sorted(got[k] for k in a[10:]) and a[-1] > 0.9 * len(got)


def test_decontamination_drops_every_text_with_a_window(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    long = [f"w{i}" for i in range(5000)]
    rows = [(1, " ".join([*long[:2500], item, *long[2500:]])), (2, " ".join(long)), (3, None), (4, ""), (2, " ".join(long)), (None, item.upper())]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_hit string")
    got = corpus_pipeline.decontamination(spark, docs, SF)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [2, 2, 3, 4]


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        assert docs.count() == 0
