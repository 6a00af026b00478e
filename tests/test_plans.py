from __future__ import annotations

import json
import os
import threading

import duckdb
import pytest

from sparkfolio.cli import POINTS
from sparkfolio.operators.discovery import discover
from sparkfolio.operators.embed import HashingEmbedder
from sparkfolio.operators.search import Request
from sparkfolio.operators.state import RUNS, STATE
from sparkfolio.operators.store import Points, Snapshots
from sparkfolio.plans.catalogue import ORACLE, QUERIES
from sparkfolio.plans.evaluation import Evaluation, evaluate, save, summary
from sparkfolio.plans.ingest import Ingest
from sparkfolio.service import Service
from sparkfolio.sources import extractor, files, index, readers
from sparkfolio.streaming.ingest import stream_points

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return list(frame.columns), sorted(map(tuple, frame.where(frame.notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_catalogue(spark, duck, name):
    assert plain(QUERIES[name](spark, SF).toPandas()) == plain(duck.execute(ORACLE[name]).df())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["paper_id", "chunk_index", "total_chunks", "chunk_text", "chunk_len"]
    assert set(e.oracle_sql()) <= set(e.queries())


def tei(title, *paragraphs):
    body = "".join(f"<div><head>{h}</head><p>{p}</p></div>" for h, p in paragraphs)
    return f'<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>{title}</title></titleStmt></fileDesc></teiHeader><text><body>{body}</body></text></TEI>'


@pytest.fixture
def stores(spark, tmp_path):
    return Points(spark, f"file://{tmp_path}/points", POINTS, buckets=4), Snapshots(spark, f"file://{tmp_path}/state", STATE)


def works(spark, n):
    return spark.createDataFrame([(f"W{i}", f"10.1/{i}", f"Title {i}", [("A",)], 2020, 100 - i, "en", [(f"http://h/{i}", "s", "J")], []) for i in range(n)], readers.WORKS)


def test_ingest_search_and_resume(spark, stores):
    points, state = stores
    job = Ingest(HashingEmbedder(64), points, state)
    files = spark.createDataFrame([("W0", tei("Foxes", ("Introduction", "Red foxes run."), ("Results", "They ran far."))), ("W1", "<broken"), ("W2", tei("Whales", ("Methods", "Blue whales swim. " * 80)))], "work_id string, tei string")
    got = {r.work_id: (r.stage, r.error, r.num_chunks) for r in job.run(works(spark, 4), files).collect()}
    assert got["W0"] == ("embedded", None, 3) and got["W1"][:2] == ("failed_processing", "no sections") and got["W3"][:2] == ("failed_download", "PDF not found")
    assert got["W2"][0] == "embedded" and got["W2"][2] > 2
    n = points.read().count()
    service = Service(points, HashingEmbedder(64))
    found = service.search("red foxes run", Request(limit=2)).collect()
    assert found[0].paper_id == "W0" and found[0].matching_section == "introduction" and found[0].title == "Title 0"
    assert [r.paper_id for r in service.search("foxes", Request(sections=["methods"])).collect()] == ["W2"]
    assert service.search("foxes", Request(year_min=2021)).count() == 0
    assert [r.section_order for r in service.paper("W0").collect()] == [0, 1, 2] and service.paper("no").count() == 0
    assert service.stats().first().points_count == n and service.health()["status"] == "healthy"
    job.run(works(spark, 4), files)
    assert points.read().count() == n
    state.write(state.read().replace("failed_processing", "downloaded", "stage").replace("failed_download", "chunked", "stage"))
    fixed = spark.createDataFrame([("W1", tei("Late", ("Summary", "It came late.")))], "work_id string, tei string")
    papers = works(spark, 4)

    got = {r.work_id: r.stage for r in job.resume(discover(papers), fixed).collect()}
    assert got == {"W0": "embedded", "W1": "embedded", "W2": "embedded", "W3": "failed_chunked"}
    assert points.read().count() == n + 2


def test_stream(spark, stores, tmp_path):
    points, _ = stores
    schema = "paper_id string, section_key string, section_type string, section_order int, content string"
    rows = spark.createDataFrame([("W0", "a", "abstract", 0, "One. Two."), ("W1", "b", "results", 0, "Three.")], schema)
    rows.write.parquet(f"{tmp_path}/in")

    papers = discover(works(spark, 2))
    for k in range(2):
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        stream_points(stream, papers, HashingEmbedder(16), points, f"{tmp_path}/check{k}").awaitTermination()
        assert points.read().count() == 2


def test_readers(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x/W1.tei.xml").write_text(tei("T", ("H", "p")))
    (tmp_path / "x/W2.pdf").write_bytes(b"x" * 1001)
    (tmp_path / "x/W3.pdf").write_bytes(b"x" * 1000)
    assert [r.paper_id for r in readers.tei(spark, f"{tmp_path}/x/*.xml").collect()] == ["W1"]
    assert [r.work_id for r in readers.landed(spark, f"{tmp_path}/x").collect()] == ["W2"]


def test_runs_are_logged_and_files_deleted(spark, stores, tmp_path):
    points, state = stores
    runs = Snapshots(spark, f"file://{tmp_path}/runs", RUNS)
    (tmp_path / "W0.pdf").write_bytes(b"x")
    landed = spark.createDataFrame([(f"{tmp_path}/W0.pdf",), (None,)], "pdf_path string")
    job = Ingest(HashingEmbedder(16), points, state, runs=runs, delete=os.remove)
    found = spark.createDataFrame([("W0", tei("T", ("Results", "Yes."))), ("W1", None)], "work_id string, tei string")
    job.run(works(spark, 2), found, landed=landed)
    job.resume(discover(works(spark, 0)), found)
    got = [(r.id, r.papers_processed, r.papers_failed, r.ended_at is not None) for r in runs.read().orderBy("id").collect()]
    assert got == [(1, 1, 1, True), (2, 0, 0, True)] and json.loads(runs.read().where("id = 1").first().config)["min_year"] == 2015
    assert not (tmp_path / "W0.pdf").exists() and os.listdir(tmp_path / "points/staging") == []


def test_points_rewrite_only_the_buckets_of_their_papers(spark, tmp_path):
    schema = "point_id string, paper_id string, section_type string, year int, embedding array<float>"
    points = Points(spark, f"file://{tmp_path}/p", schema, width=2, buckets=8)
    points.ensure()
    assert points.read().count() == 0

    def rows(*papers, v=1.0, n=2):
        return spark.createDataFrame([(f"{p}:{k}", p, "results", 2020, [v, float(k)]) for p in papers for k in range(n)], schema)

    points.merge(rows(*"abcdefghij", n=3))
    before = points._last()[1]["folders"]
    got = points.merge(rows("c", v=2.0))
    after = points._last()[1]["folders"]
    assert sum(before[b] != after[b] for b in before) == 1
    assert got.count() == 29 and got.where("paper_id = 'c'").count() == 2
    assert points.merge(rows("c", v=3.0, n=1), "upsert").where("paper_id = 'c'").count() == 2
    assert points.merge(rows()).count() == 29
    for v in range(4):
        points.merge(rows("d", v=float(v)))
    assert len(points.versions.numbers()) == 3 and points.read().count() == 28
    with pytest.raises(Exception, match="has not 2 components"):
        points.merge(spark.createDataFrame([("z:0", "z", "results", 2020, [1.0])], schema))
    assert points.read().count() == 28


def test_one_of_two_writers_publishes(spark, tmp_path):
    versions, done = files.Versions(spark, f"file://{tmp_path}/v"), []

    def write(k):
        try:
            done.append(files.Versions(spark, f"file://{tmp_path}/v").publish({"by": k}, 0))
        except RuntimeError:
            done.append(None)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(map(str, done)) == ["1"] + ["None"] * 5 and versions.numbers() == [1] and "by" in versions.read(1)
    (tmp_path / "v/.claim-00000002").touch()
    with pytest.raises(RuntimeError):
        versions.publish({}, 1)
    os.utime(tmp_path / "v/.claim-00000002", (1, 1))
    assert versions.publish({}, 1) == 2


def test_extractor_calls(spark, tmp_path):
    for i, data in enumerate((b"good", b"bad", b"lost")):
        (tmp_path / f"W{i}.pdf").write_bytes(data)
    landed = spark.createDataFrame([(f"W{i}", f"{tmp_path}/W{i}.pdf") for i in range(3)], "work_id string, pdf_path string")

    def call(name, data):
        if data == b"lost":
            raise TimeoutError
        return (200 if data == b"good" else 503), f"<{name}/>"

    assert {r.work_id: r.tei for r in extractor.extracted(landed, call).collect()} == {"W0": "<W0.pdf/>", "W1": None, "W2": None}
    assert extractor.extracted(landed.limit(0), call).count() == 0


def test_evaluation(spark, tmp_path):
    fit = "This sentence number {} is long enough to be a query of its own, surely."
    points = HashingEmbedder(64).embed(spark.createDataFrame([(f"{p}{k}", f"W{p}", f"Title of {p}", "abstract" if k == 0 else "methods", fit.format(f"{p} {p * 7}{k} w{p}")) for p in range(6) for k in range(3)], "point_id string, paper_id string, title string, section_type string, chunk_text string"), "chunk_text")
    own = Evaluation(points, HashingEmbedder(64))
    other = points.where("point_id like '%0'").selectExpr("point_id", "'' AS paper_id", "concat('https://x.org/', paper_id) AS work_id", "embedding")
    got = evaluate("c", own, "all", other)
    assert got["points"] == 18 and got["retrieval"]["ALL"]["total"] == 18 and got["retrieval"]["abstract_sentence"]["recall_at_1"] == 1.0
    c = got["compare"]
    assert c["both"] + c["a_only"] + c["b_only"] + c["neither"] == c["total_queries"] == 18 and "valid" in c["note"]
    assert got["intrinsic"]["total_papers"] == 6 and {t["section_type"] for t in got["intrinsic"]["section_types"]} == {"abstract", "methods"}
    narrow = evaluate("c", own, "compare", other.selectExpr("point_id", "paper_id", "work_id", "slice(embedding, 1, 3) AS embedding"))["compare"]
    assert narrow["both"] is None and narrow["recall_b"] is None and narrow["recall_a"] == c["recall_a"] and "skipped" in narrow["note"]
    assert evaluate("c", own, "compare")["compare"]["both"] is None
    text = summary(got)
    assert "18 points" in text and "recall@1" in text and "similarity within papers" in text
    save(spark, got, f"file://{tmp_path}/r.json")
    assert json.loads((tmp_path / "r.json").read_text())["collection"] == "c"
    assert evaluate("none", Evaluation(points.limit(0)), "intrinsic")["intrinsic"]["total_chunks"] == 0


def test_command_line(spark, tmp_path, capsys):
    from sparkfolio import cli

    works(spark, 3).write.json(f"{tmp_path}/works")
    (tmp_path / "tei").mkdir()
    for i in range(3):
        (tmp_path / f"tei/W{i}.tei.xml").write_text(tei(f"Title {i}", ("Abstract", f"Fox number {i} runs over the hills of district {i} each evening."), ("Results", f"It ran {i} miles.")))
    store = ["--store", f"file://{tmp_path}/store", "--width", "32"]
    cli.main([*store, "ingest", "--works", f"{tmp_path}/works", "--tei", f"{tmp_path}/tei/*.xml"], spark)
    cli.main([*store, "search", "fox number 2", "--limit", "2"], spark)
    cli.main([*store, "evaluate", "all", "--output", f"file://{tmp_path}/out.json"], spark)
    assert json.loads((tmp_path / "out.json").read_text())["retrieval"]["ALL"]["total"] > 0
    assert "recall@1" in capsys.readouterr().out


def test_papers_of_a_live_index(spark):
    def fetch(query, part, parts, after, size):
        assert query["min_year"] == 2015 and query["has_file"] and "best_locations" in query["fields"] and len(query["fields"]) == 9
        own = [i for i in range(100) if i % parts == part and i > (-1 if after is None else after)]
        page = own[:size]
        docs = [{"work_id": f"W{i}", "title": f"T{i}", "publication_year": 2020, "cited_by_count": i, "language": "en", "best_locations": [{"pdf_url": f"http://h/{i}", "source_id": "s", "display_name": "J"}], "other": 1} for i in page]
        return docs, page[-1] if len(own) > size else None

    works = index.works_of_index(spark, fetch, parts=3, page=7)
    assert works.count() == 100 and works.columns == [f.name for f in spark.createDataFrame([], readers.WORKS).schema]
    assert sorted(r.work_id for r in discover(works).collect()) == sorted(f"W{i}" for i in range(10, 100))
    assert index.works_of_index(spark, lambda *_: ([], None)).count() == 0


def test_settings(spark):
    from sparkfolio.config import Settings

    assert Settings.of(spark, {}) == Settings() and Settings().criteria().min_year == 2015
    spark.conf.set("spark.sparkfolio.width", "32")
    try:
        got = Settings.of(spark, {"SPARKFOLIO_WIDTH": "64", "SPARKFOLIO_MIN_YEAR": "2001", "SPARKFOLIO_STORE": "s"})
        assert (got.width, got.min_year, got.store, got.language) == (32, 2001, "s", "en")
        with pytest.raises(ValueError):
            Settings.of(spark, {"SPARKFOLIO_MIN_YEAR": "soon"})
    finally:
        spark.conf.unset("spark.sparkfolio.width")
