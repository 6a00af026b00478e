from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkfolio.operators import discovery, embed, evaluate, extract, search, state, store
from sparkfolio.sources import download, readers

TEI = (
    '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>A Title</title></titleStmt></fileDesc>'
    "<profileDesc><abstract><div><p>Abs <ref>[1]</ref>, tail.</p></div></abstract></profileDesc></teiHeader>"
    '<text><body><div>lead<head n="1">Intro</head><p>Foo <ref>[1]</ref>, bar.<lb/>baz</p>tail<p>Two.</p>'
    "<div><head>Nested</head><p>In.</p></div></div><div><head>Results</head><p>R.</p></div></body>"
    "<back><div><listBibl><biblStruct><analytic><title>Ref A</title></analytic></biblStruct></listBibl></back></text></TEI>"
).replace("<back><div>", "<back>")


def test_extract(spark):
    cjk = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><div><head>方法</head><p>a</p></div><div><head>结果</head><p>b</p></div></body></text></TEI>'
    rows = spark.createDataFrame([("p", TEI), ("bad", "<a><b>"), ("none", None), ("cjk", cjk)], "paper_id string, tei string")
    got = extract.extract(rows).orderBy("paper_id", "section_order").collect()
    own = [(r.section_order, r.section_key, r.title, r.section_type) for r in got if r.paper_id == "p"]
    assert own == [(0, "title", "Title", "title"), (1, "abstract", "Abstract", "abstract"), (2, "1_intro", "1 Intro", "body_section"), (3, "results", "Results", "results"), (4, "references", "References", "references")]
    assert got[-3].content == "Foo  [1] , bar.  baz Two. Nested In."
    assert [(r.section_key, r.content, r.section_order) for r in got if r.paper_id == "cjk"] == [("", "b", 1)]
    assert {r.paper_id for r in got} == {"p", "cjk"}
    assert extract.extract(rows, last_wins=False).where("paper_id = 'cjk'").count() == 2
    deep = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><div>' + "<p>" * 50_000 + "x" + "</p>" * 50_000 + "</div></body></text></TEI>"
    assert extract.parts(deep) == [("body", "Section 0", "x")]


def test_sections_are_read_without_python_for_each_element():
    """Elements that are no section cost no call of Python each, and neither do their ends; nested titles count in document order."""
    import sys

    tei = TEI.replace("In.", "<hi>" * 2000 + "In." + "</hi>" * 2000)
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(1) if event == "call" else None)
    try:
        got = extract.parts(tei)
    finally:
        sys.setprofile(None)
    assert len(calls) < 500 and got == extract.parts(TEI) and got[2] == ("body", "1 Intro", "Foo  [1] , bar.  baz Two. Nested In.")
    two = "<t xmlns='http://www.tei-c.org/ns/1.0'><h><titleStmt><titleStmt><title>first</title></titleStmt><title>second</title></titleStmt></h></t>"
    assert extract.parts(two) == [("title", "Title", "first")]


def works(spark, rows):
    return spark.createDataFrame(rows, readers.WORKS)


def test_discover(spark):
    good = dict(doi="https://doi.org/10.1/x", title=None, authors=[("A",), ("",), (None,), ("B",)], year=2015, n=10, lang="en", best=[("", "s", "j0"), ("p1", "s", "j1")], other=[("p2", "j2")])

    def row(work, **change):
        r = good | change
        return (work, r["doi"], r["title"], r["authors"], r["year"], r["n"], r["lang"], r["best"], r["other"])

    w = works(spark, [row("https://x.org/W1"), row("https://x.org/"), row("W2", n=50, best=[], doi=""), row("W3", best=[("", "s", "j")], other=None), row("W4", year=2014), row("W5", n=9), row("W6", lang="de"), row("W7", year=None), row(None), row("W8", n=50, best=None)])
    got = discovery.discover(w).collect()
    assert [r.work_id for r in got] == ["W2", "W8", "W1"]
    assert (got[2].doi, got[2].pdf_url, got[2].journal, got[2].authors, got[2].title) == ("10.1/x", "p1", "j1", ["A", "B"], "")
    assert (got[0].doi, got[0].pdf_url, got[0].journal) == (None, "p2", "j2")
    assert [r.work_id for r in discovery.discover(w, discovery.Criteria(max_papers=1)).collect()] == ["W2"]
    assert discovery.estimate(w) == 6


def test_search(spark):
    hits = spark.createDataFrame([("A", 1, 0.9), ("B", 2, 0.8), ("A", 3, 0.7), ("C", 4, 0.6), ("B", 5, 0.5), ("D", 0, 0.9)], "paper_id string, point_id int, score double")
    assert {(r.paper_id, r.score) for r in search.best_per(hits, ["paper_id"]).collect()} == {("A", 0.9), ("B", 0.8), ("C", 0.6), ("D", 0.9)}
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8))
    rows = [(i, i // 12, [float(v) for v in x[i]], 2010 + i % 5 if i % 7 else None, i % 3, "s%d" % (i % 2)) for i in range(60)]
    points = spark.createDataFrame(rows, "point_id int, paper_id int, embedding array<double>, year int, citation_count int, section_type string")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = unit @ unit[0]

    def plain(limit, ok):
        top = sorted((i for i in range(60) if ok(i)), key=lambda i: (-sims[i], i))[: 5 * limit]
        best: dict = {}
        for i in top:
            best.setdefault(i // 12, i)
        return sorted(best.values(), key=lambda i: (-sims[i], i))[:limit]

    for limit in (1, 2, 5):
        got = search.search(points, list(x[0]), search.Request(limit=limit)).collect()
        assert [r.point_id for r in got] == plain(limit, lambda i: True)
    request = search.Request(limit=3, year_min=2011, year_max=2013, min_citations=0, sections=["s1"])
    got = search.search(points, list(x[0]), request).collect()
    assert [r.point_id for r in got] == plain(3, lambda i: i % 7 and 1 <= i % 5 <= 3 and i % 2)
    ranked = search.ranked_papers(points.where("point_id in (0, 30)").select(F.col("point_id").alias("query_id"), F.col("embedding").alias("query")), points, 2).collect()
    assert {(r.query_id, r["rank"]) for r in ranked} == {(0, 1), (0, 2), (30, 1), (30, 2)}
    with pytest.raises(ValueError):
        search.Request(limit=0)
    assert search.stats(points).first().points_count == 60


def test_scores_of_many_queries_in_bounded_memory():
    """4,000 queries and 4,000 points: 128 MB of scores in all, which are never held at once; results are those of all scores."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(12)
    x = rng.normal(size=(4000, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[77] = x[5]  # a tie, which goes to the smaller id
    ids = pa.array(np.arange(4000))
    batch = pa.record_batch({"point_id": ids, "paper_id": pa.array(np.arange(4000) // 10), "embedding": pa.array(list(x))})
    tracemalloc.start()
    got = pa.Table.from_batches(search._block_scores(ids, x, 3, True)(iter([batch.slice(0, 2500), batch.slice(2500)])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    own = got.to_pandas()
    assert len(own) == 12_000 and (own.paper_id == own.point_id // 10).all()
    scores = np.round(x @ x.T, search.DIGITS)
    np.fill_diagonal(scores, -9)
    for q, some in own.groupby("query_id"):
        assert some.sort_values(["score", "point_id"], ascending=[False, True]).point_id.tolist() == np.lexsort((np.arange(4000), -scores[q]))[:3].tolist()


def test_metrics_golden(spark):
    ranks = {"abstract_sentence": [1, 1, 1, 3], "method_phrase": [1, 1, 1, 2], "title": [1, 1, 1, 4]}
    rows = spark.createDataFrame([(k, r) for k, v in ranks.items() for r in v], "query_type string, rank int")
    got = {r.query_type: (r.total, r.recall_at_1, r.recall_at_10, r.mrr) for r in evaluate.retrieval_metrics(rows).collect()}
    assert got == {"abstract_sentence": (4, 0.75, 1.0, 0.833), "method_phrase": (4, 0.75, 1.0, 0.875), "title": (4, 0.75, 1.0, 0.812), "ALL": (12, 0.75, 1.0, 0.84)}
    empty = evaluate.retrieval_metrics(rows.limit(0)).collect()
    assert [(r.query_type, r.total, r.mrr) for r in empty] == [("ALL", 0, 0.0)]
    hits = spark.createDataFrame([(i, True, i == 0) for i in range(12)], "query_id int, in_a boolean, in_b boolean")
    assert tuple(evaluate.compare(hits).first()) == (1, 11, 0, 0, 1.0, 0.083)
    ratio = spark.range(1).select(evaluate.separation(F.lit(0.753), F.lit(0.678)), evaluate.separation(F.lit(0.5), F.lit(0.0))).first()
    assert ratio[0] == 1.111 and ratio[1] == math.inf


def test_similarities_equal_pairs(spark):
    rng = np.random.default_rng(2)
    x, key = rng.normal(size=(40, 6)), rng.integers(0, 5, 40)
    x[7] = 0
    key[3] = 99
    points = spark.createDataFrame([(int(k), [float(v) for v in r]) for k, r in zip(key, x, strict=True)], "k int, embedding array<double>")
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    u = x / np.where(norm == 0, 1, norm)
    s = u @ u.T
    for r in evaluate.mean_similarity(points, "k").collect():
        own = np.flatnonzero(key == r.k)
        assert abs(r.sim - np.mean([s[i, j] for i in own for j in own if i < j])) < 1e-12
    across = [s[i, j] for i in range(40) for j in range(40) if key[i] != key[j] and i != 7 and j != 7]
    assert abs(evaluate.cross_similarity(points, "k").first().sim - np.mean(across)) < 1e-12
    assert evaluate.cross_similarity(points.limit(0), "k").first().sim == 0.0


def test_queries(spark):
    fit = "This sentence is long enough to be a query of its own, surely."
    rows = [("p", 1, "abstract", "Short. " + fit, "T"), ("p", 2, "abstract", fit, "T"), ("p", 3, "methods", "No.", "T"), ("p", 4, "methods", fit + " x", "T"), ("p", 5, "results", fit, "T"), ("q", 1, "abstract", fit, "")]
    chunks = spark.createDataFrame(rows, "paper_id string, point_id int, section_type string, chunk_text string, title string")
    got = evaluate.benchmark_queries(chunks, 3).orderBy("slot").collect()
    assert [(r.paper_id, r.query_type) for r in got] == [("p", "title"), ("p", "abstract_sentence"), ("p", "method_phrase")]
    assert evaluate.benchmark_queries(chunks, 1).count() == 1


def test_state(spark):
    papers = spark.createDataFrame([("a", "A"), ("b", "B"), ("b", "B2")], "work_id string, title string")
    empty = spark.createDataFrame([], state.STATE)
    assert [tuple(r) for r in state.progress(empty).collect()] == [("total", 0, "")]
    s = state.registered(empty, papers)
    assert s.count() == 2 and s.where("stage = 'discovered' and metadata like '%title%'").count() == 2
    assert state.registered(s, papers).count() == 2
    s = state.moved(s, spark.createDataFrame([("a", "failed_download", "gone")], "work_id string, stage string, error string"))
    assert state.unprocessed(papers, s).count() == 3
    s = state.moved(s, spark.createDataFrame([("a", "embedded", 3)], "work_id string, stage string, num_chunks int"))
    a = s.where("work_id = 'a'").first()
    assert (a.stage, a.error, a.num_chunks) == ("embedded", None, 3)
    assert state.unprocessed(papers, s).count() == 2 and state.work_left(s).first()[0] == 1
    assert [r.work_id for r in state.pending(s, "downloaded").collect()] == ["b"]


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "a", 0), (3, "b", 0)], "point_id int, paper_id string, v int")
    new = spark.createDataFrame([(1, "a", 1)], "point_id int, paper_id string, v int")
    once = store.upsert(old, new)
    assert sorted(map(tuple, once.collect())) == [(1, "a", 1), (2, "a", 0), (3, "b", 0)]
    assert sorted(map(tuple, store.upsert(once, new).collect())) == sorted(map(tuple, once.collect()))
    assert sorted(map(tuple, store.replace_papers(old, new).collect())) == [(1, "a", 1), (3, "b", 0)]
    assert store.without_paper(old, "a").count() == 1
    twice = spark.createDataFrame([(1, "a", 5), (1, "a", 7), (1, "a", 6)], "point_id int, paper_id string, v int")
    assert sorted(map(tuple, store.upsert(old, twice, order="v").collect())) == [(1, "a", 7), (2, "a", 0), (3, "b", 0)]
    assert store.upsert(old, twice).count() == 3


def test_download(spark):
    big, calls, waits = b"x" * 1000, [], []

    def fetch(url):
        calls.append(url)
        if url == "lost":
            raise ConnectionError("no")
        return {"ok": (200, "application/pdf", big), "html": (200, "text/html", big), "small": (200, "application/octet-stream", b"x"), "gone": (404, "", b"")}[url]

    def save(w, data):
        return f"/files/{w}.pdf"

    one = lambda u: download.fetch_one("w", u, fetch, save, sleep=waits.append)
    assert one("ok") == ("w", True, "/files/w.pdf", None)
    assert one("html")[3] == "Not a PDF: text/html" and one("small")[3] == "File too small: 1 bytes" and one(None)[3] == "No PDF URL"
    assert one("gone")[3] == "HTTP 404" and one("lost")[3] == "ConnectionError: no"
    assert waits == [1.0, 2.0, 1.0, 2.0] and calls.count("gone") == 3
    papers = spark.createDataFrame([("a", "http://h/1"), ("b", "http://h/2"), ("c", None)], "work_id string, pdf_url string")
    have = spark.createDataFrame([("a", "/have")], "work_id string, pdf_path string")
    got = {r.work_id: (r.success, r.pdf_path) for r in download.download(papers, lambda u: (200, "pdf", b"y" * 2000), save, have, pause=0).collect()}
    assert got == {"a": (True, "/have"), "b": (True, "/files/b.pdf"), "c": (False, None)}


def test_embedders(spark):
    texts = spark.createDataFrame([(0, "red fox red"), (1, "fox red red"), (2, "blue"), (3, "")], "id int, x string")
    got = {r.id: r.embedding for r in embed.HashingEmbedder(32).embed(texts, "x").collect()}
    assert np.allclose(got[0], got[1]) and not np.allclose(got[0], got[2]) and np.allclose(got[3], 0)
    assert all(abs(np.linalg.norm(got[i]) - 1) < 1e-6 and len(got[i]) == 32 for i in (0, 1, 2))
    model = embed.ModelEmbedder(lambda: lambda ts: np.array([[len(t), 1.0] for t in ts]), 2)
    assert {r.id: list(r.embedding) for r in model.embed(texts, "x").collect()}[2] == [4.0, 1.0]
    table = spark.createDataFrame([(0, [1.0])], "id int, embedding array<double>")
    assert embed.Precomputed(table, "id").embed(texts, "x").count() == 1


def test_shuffled_partitions_change_nothing(spark):
    rng = random.Random(1)
    rows = [(i, i // 4, [rng.random() for _ in range(4)]) for i in range(200)]
    points = spark.createDataFrame(rows, "point_id int, paper_id int, embedding array<double>")
    a, b = (search.top_points(points.repartition(n), rows[0][2], 30).select("point_id", "score").collect() for n in (1, 9))
    assert a == b
