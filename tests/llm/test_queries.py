"""The queries as they are called, over whole tables, against plain restatements of their contracts."""

from __future__ import annotations

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest

pytest.importorskip("sparkfolio.llm")

from test_corpus import PLAIN, SPACED, components, fits, held, sets_of, water  # noqa: E402

from sparkfolio.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.connect().execute(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet'").fetchall()


def run(spark, name):
    got = queries.QUERIES[name](spark, SF)
    return dict(got.dtypes), got.collect()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_ngram_jaccard_join(spark, docs):
    kinds, got = run(spark, "op1_ngram_jaccard_join")
    sets = sets_of([(i, t) for i, t, _ in docs], 3)
    want = components(sets, 90)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), want[i]) for i, s in sets.items()} and len(got) == len(docs)
    assert kinds["n_shingles"] == kinds["component_id"] == "bigint"


def test_mixing(spark, docs):
    kinds, got = run(spark, "op2_mixing")
    size: dict = {}
    own = {i: len(SPACED.findall(t or "")) for i, t, _ in docs}
    for i, _, s in docs:
        size[s] = size.get(s, 0) + own[i]
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    goal = dict(zip(order, water([size[s] for s in order], [(3, 1, 2)[k % 3] for k in range(len(order))], 1.5, 2), strict=True))
    source = {i: s for i, _, s in docs}
    assert {r.doc_id: r.size for r in got} == own and len(got) == len(docs)
    for s in order:
        rows = [r for r in got if source[r.doc_id] == s]
        assert all(r.source_size == size[s] and abs(r.target - goal[s]) < 1e-6 and r.taken <= 2 * r.size for r in rows)
        assert abs(sum(r.taken for r in rows) - goal[s]) <= max((r.size for r in rows), default=0)
        done = sorted(float(p) for r in rows for p in r.positions.split(",") if p)
        if goal[s] > 10 * max(r.size for r in rows):  # passages of a source spread over all of training
            assert done[0] < 0.2 and done[-1] > 0.8
    assert (kinds["size"], kinds["target"], kinds["taken"]) == ("bigint", "double", "bigint")
    assert sorted(map(str, got)) == sorted(map(str, run(spark, "op2_mixing")[1]))


def test_pii(spark, docs):
    kinds, got = run(spark, "op3_pii")
    text = {i: t or "" for i, t, _ in docs}
    for r in got:
        base = sorted((m.start(), i, k, m.end()) for i, k in enumerate(PLAIN) for m in re.finditer(PLAIN[k], text[r.doc_id]) if fits(k, m[0]))
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(b[2] == k for b in base) for k in PLAIN]
        shown = [f"{k}:{a}:{b}" for a, _, k, b in base]
        assert r.base_sha256 == sha(",".join(shown)) and set(shown) <= set(r.spans.split(",")) | {""}
    assert kinds["n_email"] == "bigint" and len(got) == len(docs)


def test_license_scan(spark, docs):
    _, got = run(spark, "op4_license_scan")
    assert {r.doc_id: r.licenses for r in got} == {i: ",".join(held(t)) for i, t, _ in docs}
    assert all(r.n_licenses == len([x for x in r.licenses.split(",") if x]) for r in got)


def test_substring_dedup(spark, docs):
    """Words of runs of 50 or more that another document has too are marked; marked documents have such a passage or a similar one."""
    _, got = run(spark, "op5_substring_dedup")
    assert len(got) == len(docs)
    words = {i: [w.lower() if w.isascii() else w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in SPACED.findall(t or "")] for i, t, _ in docs}
    first: dict = {}
    for i, w in words.items():
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), set()).add(i)
    for r in got:
        w = words[r.doc_id]
        marked = {k for s in r.spans.split(",") if s for k in range(*map(int, s.split(":")))}
        assert len(marked) == r.n_repeated and r.n_words == len(w) and r.first_doc <= r.doc_id
        want = {j for k in range(len(w) - 49) if len(first[tuple(w[k : k + 50])]) > 1 for j in range(k, k + 50)}
        assert want <= marked


def test_ann(spark):
    kinds, got = run(spark, "op6_ann")
    rows = duckdb.connect().execute(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    unit, hits = x / np.linalg.norm(x, axis=1, keepdims=True), 0
    found: dict = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == {int(i) for i in ids if i % 50 == 0}
    for q, own in found.items():
        s = unit @ unit[ids == q][0]
        s[ids == q] = -9
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5] and [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        assert all(abs(s[ids == r.vec_id][0] - r.score) < 1e-12 for r in own)
        hits += len({r.vec_id for r in own} & set(ids[np.lexsort((ids, -s.round(12)))[:5]].tolist()))
    assert hits >= 0.9 * 5 * len(found)
    assert (kinds["query_id"], kinds["rank"], kinds["vec_id"], kinds["score"]) == ("bigint", "int", "bigint", "double")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


def test_sharding(spark, docs):
    _, got = run(spark, "op8_sharding")
    assert sorted(r.doc_id for r in got) == sorted(i for i, _, _ in docs)
    counts: dict = {}
    for r in got:
        counts[r.shard] = counts.get(r.shard, 0) + 1
    assert all(counts[r.shard] == r.shard_rows for r in got)


def test_quality(spark, docs):
    kinds, got = run(spark, "op10_quality")
    assert len(got) == len(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got) and (kinds["score"], kinds["predicted"]) == ("double", "int")
    labels = dict(duckdb.connect().execute(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    test = [r for r in got if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in test) >= 0.9 * len(test) > 0
