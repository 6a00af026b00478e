"""Queries over the test tables, one for each group of operators, and the same in DuckDB's SQL.

``documents`` stand for papers (citations: n_chars, year: 2010 + doc_id % 15, journal: source) and for sections;
``embeddings`` stand for points (paper: vec_id div 10, section type: label).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import host, point_id, section_type, sentences, slug
from ..operators.chunk import chunk
from ..operators.discovery import Criteria, author_names, discover, estimate, first_location, located
from ..operators.evaluate import benchmark_queries, compare, cross_similarity, length_stats, mean_similarity, rank_of_source, retrieval_metrics, sentence_queries, separation, separation_label
from ..operators.extract import extract, keep_last
from ..operators.search import Request, best_per, paper_chunks, paper_scroll, ranked_papers, results, sample_chunks, search, stats, top_points
from ..operators.state import RUNS, STATE, after_resume, chunk_counters, insert_or_ignore, metadata, outcome, pending, progress, registered, run_ended, run_started, unprocessed, work_left
from ..operators.store import payload, replace_papers, upsert
from .evaluation import Evaluation, named

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """A file of one row group is one task; stages that compute much want as many as there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def _works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` in the shape of a raw metadata index, with the gaps that such an index has."""
    d, i = _read(spark, sf_dir, "documents"), F.col("doc_id")
    url = F.concat(F.lit("http://h"), (i % 7).cast("string"), F.lit(".org/"), i.cast("string"))
    best = F.array(F.struct(F.when(i % 4 != 3, "").alias("pdf_url"), F.lit("s").alias("source_id"), F.lit("j0").alias("display_name")), F.struct(F.when(i % 2 == 0, url).alias("pdf_url"), F.lit("s").alias("source_id"), F.col("source").alias("display_name")))
    other = F.array(F.struct(F.when(i % 5 != 0, url).alias("pdf_url"), F.col("lang").alias("display_name")))
    return d.select(
        F.when(i % 11 == 10, "https://x.org/").otherwise(F.concat(F.lit("https://x.org/W"), i.cast("string"))).alias("work_id"),
        F.when(i % 3 == 0, F.concat(F.lit("https://doi.org/10.1/"), i.cast("string"))).when(i % 3 == 1, F.concat(F.lit("10.2/"), i.cast("string"))).otherwise("").alias("doi"),
        F.col("source").alias("title"),
        F.array(*[F.struct(x.alias("display_name")) for x in (F.col("lang"), F.lit(""), F.lit(None).cast("string"), F.col("source"))]).alias("authors"),
        (2010 + i % 15).cast("int").alias("publication_year"),
        F.col("n_chars").cast("int").alias("cited_by_count"),
        F.col("lang").alias("language"),
        best.alias("best_locations"),
        other.alias("locations"),
        "doc_id",
    )


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("point_id"), (F.col("vec_id") / 10).cast("long").alias("paper_id"), F.col("label").alias("section_type"), "embedding")


def _query_zero(points: DataFrame) -> list[float]:
    return list(points.where("point_id = 0").first()["embedding"])


_SPACE = r"[\s\p{Z}\x{85}\x0b\x1c-\x1f]"
_STRIPPED = rf"regexp_replace(text, '^{_SPACE}+|{_SPACE}+$', '', 'g')"
_SENTENCES = rf"list_filter(string_split(regexp_replace({_STRIPPED}, '([.!?]){_SPACE}+', '\1' || chr(1), 'g'), chr(1)), lambda s: s <> '')"
_DOT = "list_sum(list_transform(range(1, 65), lambda i: a.e[i] * b.e[i]))"
_VECS = "(SELECT vec_id, vec_id // 10 AS paper_id, label, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n FROM embeddings)"
_COS = f"{_DOT} / (a.n * b.n)"


@query("""SELECT doc_id AS paper_id, (2010 + doc_id % 15)::INT AS year, n_chars AS citation_count FROM documents
WHERE lang = 'en' AND 2010 + doc_id % 15 >= 2015 AND n_chars >= 10 ORDER BY n_chars DESC, doc_id LIMIT 100""")
def discover_filter_topn(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", (2010 + F.col("doc_id") % 15).cast("int").alias("year"))
    kept = d.where((F.col("lang") == "en") & (F.col("year") >= 2015) & (F.col("n_chars") >= 10))
    return kept.orderBy(F.desc("n_chars"), "doc_id").limit(100).select(F.col("doc_id").alias("paper_id"), "year", F.col("n_chars").alias("citation_count"))


@query("""WITH w AS (SELECT doc_id, source, lang, n_chars, 'http://h' || (doc_id % 7) || '.org/' || doc_id AS url FROM documents WHERE lang = 'en' AND 2010 + doc_id % 15 >= 2015 AND n_chars >= 10 AND doc_id % 11 <> 10)
SELECT 'W' || doc_id AS work_id, (2010 + doc_id % 15)::INT AS year, n_chars::INT AS citation_count, url AS pdf_url, CASE WHEN doc_id % 2 = 0 THEN source ELSE lang END AS journal,
CASE doc_id % 3 WHEN 0 THEN '10.1/' || doc_id WHEN 1 THEN '10.2/' || doc_id END AS doi FROM w WHERE doc_id % 2 = 0 OR doc_id % 5 <> 0""")
def discover_papers(spark, sf_dir):
    return discover(_works(spark, sf_dir), Criteria()).select("work_id", "year", "citation_count", "pdf_url", "journal", "doi")


@query("""SELECT doc_id, doc_id % 4 <> 3 OR doc_id % 2 = 0 OR doc_id % 5 <> 0 AS located,
CASE WHEN doc_id % 2 = 0 OR doc_id % 5 <> 0 THEN 'http://h' || (doc_id % 7) || '.org/' || doc_id END AS pdf_url,
CASE WHEN doc_id % 2 = 0 THEN source WHEN doc_id % 5 <> 0 THEN lang END AS journal FROM documents""")
def discover_nested_exists(spark, sf_dir):
    w = _works(spark, sf_dir).withColumn("at", first_location(F.col("best_locations"), F.col("locations")))
    return w.select("doc_id", located(F.col("best_locations"), F.col("locations")).alias("located"), F.col("at.pdf_url").alias("pdf_url"), F.col("at.display_name").alias("journal"))


@query("""SELECT doc_id, (i - 1)::INT AS pos, a[i] AS author FROM (SELECT doc_id, list_filter([lang, '', NULL, source], lambda x: x IS NOT NULL AND x <> '') AS a FROM documents), unnest(range(1, len(a) + 1)) AS t(i)""")
def authors_project(spark, sf_dir):
    return _works(spark, sf_dir).select("doc_id", F.posexplode(author_names(F.col("authors"))).alias("pos", "author"))


@query("""SELECT doc_id, CASE WHEN doc_id % 11 = 10 THEN '' ELSE 'W' || doc_id END AS work_id, CASE doc_id % 3 WHEN 0 THEN '10.1/' || doc_id WHEN 1 THEN '10.2/' || doc_id END AS doi FROM documents""")
def normalize_ids(spark, sf_dir):
    from ..functions.text import bare_doi, last_segment

    return _works(spark, sf_dir).select("doc_id", last_segment(F.col("work_id")).alias("work_id"), bare_doi(F.col("doi")).alias("doi"))


@query("""SELECT regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1) AS host, count(*) AS cnt FROM pages GROUP BY 1""")
def url_domain_counts(spark, sf_dir):
    return _read(spark, sf_dir, "pages").groupBy(host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("cnt"))


@query(f"""SELECT doc_id, (i - 1)::INT AS pos, s[i] AS sentence FROM (SELECT doc_id, {_SENTENCES} AS s FROM documents), unnest(range(1, len(s) + 1)) AS t(i)""")
def sentence_split(spark, sf_dir):
    d = _spread(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.posexplode(sentences(F.col("text"))).alias("pos", "sentence"))


_CHUNKED = f"""WITH s AS (SELECT doc_id, lang, source, {_SENTENCES} AS s FROM documents),
f AS (SELECT doc_id, lang, source, list_reduce(list_transform(s, lambda x: {{'o': []::VARCHAR[], 'c': '', 'x': x}}), lambda a, b:
  CASE WHEN length(b.x) > 1000 THEN {{'o': list_append(CASE WHEN a.c = '' THEN a.o ELSE list_append(a.o, a.c) END, b.x), 'c': '', 'x': ''}}
  WHEN length(a.c) + length(b.x) + 1 > 1000 THEN {{'o': CASE WHEN a.c = '' THEN a.o ELSE list_append(a.o, a.c) END, 'c': b.x, 'x': ''}}
  ELSE {{'o': a.o, 'c': CASE WHEN a.c = '' THEN b.x ELSE a.c || ' ' || b.x END, 'x': ''}} END, {{'o': []::VARCHAR[], 'c': '', 'x': ''}}) AS r FROM s WHERE len(s) > 0),
g AS (SELECT doc_id, lang, source, CASE WHEN r.c = '' THEN r.o ELSE list_append(r.o, r.c) END AS c FROM f),
chunks AS (SELECT doc_id AS paper_id, lang, source, (i - 1)::INT AS chunk_index, len(c)::BIGINT AS total_chunks, c[i] AS chunk_text, length(c[i])::INT AS chunk_len FROM g, unnest(range(1, len(c) + 1)) AS t(i))
"""


@query(_CHUNKED + "SELECT paper_id, chunk_index, total_chunks, chunk_text, chunk_len FROM chunks")
def chunk_documents(spark, sf_dir):
    d = _spread(_read(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"), "text"))
    return chunk(d, ["paper_id"], "text")


@query(_CHUNKED + """SELECT lang AS section_type, count(*) AS n, round_even(avg(chunk_len), 1) AS avg_len, round_even(quantile_cont(chunk_len, 0.5), 1) AS median_len,
round_even(quantile_cont(chunk_len, 0.05), 1) AS p5_len, round_even(quantile_cont(chunk_len, 0.95), 1) AS p95_len FROM chunks GROUP BY 1""")
def chunk_stats_by_section(spark, sf_dir):
    d = _spread(_read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("section_type"), "text"))
    return length_stats(chunk(d, ["doc_id", "section_type"], "text"), ["section_type"], "chunk_text")


@query(_CHUNKED + """SELECT paper_id, count(*) AS num_chunks, 1::BIGINT AS num_sections FROM chunks GROUP BY 1""")
def counts_per_paper(spark, sf_dir):
    d = _spread(_read(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"), "lang", "text"))
    return chunk(d, ["paper_id", "lang"], "text").groupBy("paper_id").agg(F.count(F.lit(1)).alias("num_chunks"), F.countDistinct("lang").alias("num_sections"))


_TITLES = ("Abstract", "1 Introduction", "Background", "Materials and Methods", "Experimental setup", "Results and Discussion", "Key findings", "Discussion", "Summary", "Conclusions", "Bibliography", "Acknowledgements", "Supplementary data", "Supplementary methods", "Related work", "")
_TITLE_LIST = "[" + ", ".join(f"'{t}'" for t in _TITLES) + "]"
_TYPE = """CASE WHEN t LIKE '%abstract%' THEN 'abstract' WHEN t LIKE '%introduction%' OR t LIKE '%background%' THEN 'introduction'
WHEN t LIKE '%method%' OR t LIKE '%material%' OR t LIKE '%experimental%' OR t LIKE '%procedure%' THEN 'methods' WHEN t LIKE '%result%' OR t LIKE '%finding%' THEN 'results'
WHEN t LIKE '%discussion%' THEN 'discussion' WHEN t LIKE '%conclusion%' OR t LIKE '%summary%' THEN 'conclusion' WHEN t LIKE '%reference%' OR t LIKE '%bibliography%' THEN 'references'
WHEN t LIKE '%acknowledgment%' OR t LIKE '%acknowledgement%' THEN 'acknowledgments' WHEN t LIKE '%appendix%' OR t LIKE '%supplement%' THEN 'appendix' ELSE 'body_section' END"""


def _titled(spark, sf_dir) -> DataFrame:
    titles = F.array(*[F.lit(t) for t in _TITLES])
    return _read(spark, sf_dir, "documents").select("doc_id", "lang", F.element_at(titles, (F.col("doc_id") % len(_TITLES) + 1).cast("int")).alias("title"))


@query(f"""SELECT doc_id, title, {_TYPE} AS section_type FROM (SELECT doc_id, title, lower(title) AS t FROM (SELECT doc_id, {_TITLE_LIST}[doc_id % {len(_TITLES)} + 1] AS title FROM documents))""")
def classify_sections(spark, sf_dir):
    return _titled(spark, sf_dir).select("doc_id", "title", section_type(F.col("title")).alias("section_type"))


@query(f"""WITH s AS (SELECT doc_id, doc_id // 40 AS paper_id, trim(regexp_replace(lower({_TITLE_LIST}[doc_id % {len(_TITLES)} + 1] || ' ' || lang), '[^a-z0-9]+', '_', 'g'), '_') AS section_key FROM documents),
o AS (SELECT *, (row_number() OVER (PARTITION BY paper_id ORDER BY doc_id) - 1)::INT AS section_order FROM s)
SELECT paper_id, section_key, section_order, doc_id FROM o QUALIFY row_number() OVER (PARTITION BY paper_id, section_key ORDER BY section_order DESC) = 1""")
def section_slug_lastwins(spark, sf_dir):
    s = _titled(spark, sf_dir).withColumn("paper_id", (F.col("doc_id") / 40).cast("long"))
    s = s.withColumn("section_key", slug(F.concat_ws(" ", "title", "lang")))
    s = s.withColumn("section_order", (F.row_number().over(Window.partitionBy("paper_id").orderBy("doc_id")) - 1).cast("int"))
    return keep_last(s).select("paper_id", "section_key", "section_order", "doc_id")


@query(f"""WITH d AS (SELECT doc_id, source, lang, {_STRIPPED} AS c FROM documents)
SELECT doc_id::VARCHAR AS paper_id, 'title' AS section_key, 'title' AS section_type, 0::INT AS section_order, md5(source) AS content FROM d
UNION ALL SELECT doc_id::VARCHAR, 'abstract', 'abstract', 1::INT, md5(lang) FROM d
UNION ALL SELECT doc_id::VARCHAR, '1_introduction', 'introduction', 2::INT, md5(c) FROM d WHERE c <> ''
UNION ALL SELECT doc_id::VARCHAR, 'references', 'references', (CASE WHEN c <> '' THEN 3 ELSE 2 END)::INT, md5(source || chr(10) || lang) FROM d""")
def tei_extract(spark, sf_dir):
    """Documents written as structured XML and read back."""

    def escaped(c):
        return F.replace(F.replace(F.replace(F.regexp_replace(c, "[^\\x09\\x0A\\x0D\\x20-\\uD7FF\\uE000-\\uFFFD\\x{10000}-\\x{10FFFF}]", ""), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    d = _spread(_read(spark, sf_dir, "documents"))
    text, source, lang = (escaped(F.col(c)) for c in ("text", "source", "lang"))
    tei = F.concat(
        F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>'), source, F.lit("</title></titleStmt></fileDesc><profileDesc><abstract><p>"), lang,
        F.lit('</p></abstract></profileDesc></teiHeader><text><body><div><head n="1">Introduction</head><p>'), text, F.lit("</p></div></body><back><listBibl><biblStruct><title>"), source,
        F.lit("</title></biblStruct><biblStruct><title>"), lang, F.lit("</title></biblStruct></listBibl></back></text></TEI>"),
    )
    s = extract(d.select(F.col("doc_id").alias("paper_id"), tei.alias("tei")))
    return s.select("paper_id", "section_key", "section_type", "section_order", F.md5(F.col("content").cast("binary")).alias("content"))


@query("""SELECT doc_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab', (instr('0123456789abcdef', h[17:17]) - 1)::INT % 4 + 1, 1) || h[18:20] || '-' || h[21:32] AS point_id
FROM (SELECT doc_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(doc_id || ':' || lang || ':' || (doc_id % 3))) AS h FROM documents)""")
def point_ids_uuid5(spark, sf_dir):
    d = _read(spark, sf_dir, "documents")
    return d.select("doc_id", point_id(F.col("doc_id"), F.col("lang"), F.col("doc_id") % 3).alias("point_id"))


_UUID5 = "h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab', (instr('0123456789abcdef', h[17:17]) - 1)::INT % 4 + 1, 1) || h[18:20] || '-' || h[21:32]"


@query(_CHUNKED + f"""SELECT {_UUID5} AS point_id, paper_id, chunk_index, total_chunks, 'sentence_split' AS chunking_method, journal, year, citation_count, doi FROM (
SELECT c.paper_id, c.chunk_index, c.total_chunks, d.source AS journal, (2010 + d.doc_id % 15)::INT AS year, CASE WHEN d.doc_id % 9 = 0 THEN 0 ELSE d.n_chars END AS citation_count, CASE WHEN d.doc_id % 3 = 2 THEN '' ELSE '10.1/' || d.doc_id END AS doi,
sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(c.paper_id || ':' || c.lang || ':' || c.chunk_index)) AS h FROM chunks c JOIN documents d ON c.paper_id = d.doc_id)""")
def denormalize_payload(spark, sf_dir):
    d, i = _read(spark, sf_dir, "documents"), F.col("doc_id")
    papers = d.select(i.alias("work_id"), F.when(i % 3 != 2, F.concat(F.lit("10.1/"), i.cast("string"))).alias("doi"), F.lit("t").alias("title"), F.array(F.lit("a")).alias("authors"), (2010 + i % 15).cast("int").alias("year"), F.when(i % 9 != 0, F.col("n_chars")).alias("citation_count"), F.col("source").alias("journal"))
    chunks = chunk(_spread(d.select(i.alias("paper_id"), F.col("lang").alias("section"), "text")), ["paper_id", "section"], "text")
    chunks = chunks.withColumns({"section_type": F.col("section"), "section_order": F.lit(0), "embedding": F.array(F.lit(1.0))})
    return payload(chunks, papers).select("point_id", "paper_id", "chunk_index", "total_chunks", "chunking_method", "journal", "year", "citation_count", "doi")


def _top(where: str, limit: int) -> str:
    return f"(SELECT a.paper_id, a.vec_id AS point_id, a.label, {_COS} AS score FROM {_VECS} a, {_VECS} b WHERE b.vec_id = 0 {where} ORDER BY score DESC, point_id LIMIT {limit})"


@query(f"SELECT point_id, round(score, 6) AS score FROM {_top('', 50)}")
def vector_topk(spark, sf_dir):
    p = _points(spark, sf_dir)
    return top_points(p, _query_zero(p), 50).select("point_id", F.round("score", 6).alias("score"))



@query(f"""SELECT paper_id, point_id, round(s, 6) AS score FROM (SELECT paper_id, point_id, score AS s FROM {_top("", 50)} QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY score DESC, point_id) = 1) ORDER BY s DESC, point_id LIMIT 10""")
def search_dedup(spark, sf_dir):
    p = _points(spark, sf_dir)
    return best_per(top_points(p, _query_zero(p), 50), ["paper_id"]).orderBy(F.desc("score"), "point_id").limit(10).select("paper_id", "point_id", F.round("score", 6).alias("score"))


@query(f"""SELECT paper_id, point_id, round(s, 6) AS score FROM (SELECT paper_id, point_id, score AS s FROM {_top("AND a.label IN (1, 2, 3)", 50)} QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY score DESC, point_id) = 1) ORDER BY s DESC, point_id LIMIT 10""")
def search_filtered_sections(spark, sf_dir):
    p = _points(spark, sf_dir)
    hits = top_points(p.where(F.col("section_type").isin(1, 2, 3)), _query_zero(p), 50)
    return best_per(hits, ["paper_id"]).orderBy(F.desc("score"), "point_id").limit(10).select("paper_id", "point_id", F.round("score", 6).alias("score"))


@query("""SELECT conv_id AS paper_id, turn AS section_order, (row_number() OVER (ORDER BY turn))::BIGINT AS place, text AS chunk_text FROM conversations WHERE conv_id = 7""")
def paper_chunks_in_order(spark, sf_dir):
    c = _read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("paper_id"), F.col("turn").alias("section_order"), F.lit(0).alias("chunk_index"), F.col("turn").alias("point_id"), F.col("text").alias("chunk_text"))
    found = paper_chunks(c, 7)
    return found.select("paper_id", "section_order", F.row_number().over(Window.partitionBy("paper_id").orderBy("section_order", "chunk_index")).cast("long").alias("place"), "chunk_text")


@query("SELECT count(*) AS points_count, count(embedding) AS vectors_count, 'green' AS status FROM embeddings")
def collection_stats(spark, sf_dir):
    return stats(_points(spark, sf_dir))


@query("SELECT DISTINCT vec_id // 10 AS paper_id FROM embeddings")
def distinct_papers(spark, sf_dir):
    return _points(spark, sf_dir).select("paper_id").distinct()


_RANKED = f"""hits AS (SELECT b.vec_id AS query_id, a.vec_id AS point_id, a.paper_id, {_COS} AS score FROM {_VECS} a, {_VECS} b WHERE b.vec_id % 25 = 0 %s
QUALIFY row_number() OVER (PARTITION BY b.vec_id ORDER BY {_COS} DESC, a.vec_id) <= 50),
papers AS (SELECT query_id, paper_id, max(score) AS s FROM hits GROUP BY 1, 2),
ranked AS (SELECT query_id, paper_id, s, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, paper_id) AS rank FROM papers QUALIFY rank <= 10)"""


def _queries(points: DataFrame) -> DataFrame:
    return points.where("point_id % 25 = 0").select(F.col("point_id").alias("query_id"), F.col("embedding").alias("query"))


@query("WITH " + _RANKED.replace("%s", "").replace("% 25", "% 25") + " SELECT query_id, paper_id, round(s, 6) AS score, rank::INT AS rank FROM ranked")
def topk_multi_query(spark, sf_dir):
    p = _points(spark, sf_dir)
    return ranked_papers(_queries(p), p, 10).select("query_id", "paper_id", F.round("score", 6).alias("score"), "rank")


@query(rf"""WITH s AS (SELECT doc_id, unnest({_SENTENCES}) AS s FROM documents)
SELECT doc_id AS paper_id, 1::INT AS slot, 'abstract_sentence' AS query_type, s AS query_text FROM s WHERE length(s) BETWEEN 40 AND 200 AND NOT regexp_matches(s, '\[\d+\]') AND NOT regexp_matches(s, '[{{}}=]') AND NOT contains(s, 'http')
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY sha1('42:' || doc_id || ':1:' || s), s) = 1""")
def benchmark_sentences(spark, sf_dir):
    d = _spread(_read(spark, sf_dir, "documents"))
    return sentence_queries(d.select(F.col("doc_id").alias("paper_id"), F.col("doc_id").alias("point_id"), F.lit("abstract").alias("section_type"), F.col("text").alias("chunk_text")))


def _sourced(points: DataFrame) -> DataFrame:
    """The queries with the paper they come from and, for a type, its parity."""
    return points.where("point_id % 25 = 0").select(F.col("point_id").alias("query_id"), F.col("paper_id").alias("source"), F.concat(F.lit("type"), (F.col("paper_id") % 2).cast("string")).alias("query_type"))


@query("WITH " + _RANKED.replace("%s", "AND a.vec_id <> b.vec_id") + """, r AS (SELECT q.vec_id AS query_id, 'type' || (q.vec_id // 10 % 2) AS query_type, ranked.rank FROM embeddings q LEFT JOIN ranked ON ranked.query_id = q.vec_id AND ranked.paper_id = q.vec_id // 10 WHERE q.vec_id % 25 = 0)
SELECT coalesce(query_type, 'ALL') AS query_type, count(*) AS total, count(rank) AS found, round_even(avg(CASE WHEN rank <= 1 THEN 1.0 ELSE 0.0 END), 3) AS recall_at_1, round_even(avg(CASE WHEN rank <= 5 THEN 1.0 ELSE 0.0 END), 3) AS recall_at_5,
round_even(avg(CASE WHEN rank <= 10 THEN 1.0 ELSE 0.0 END), 3) AS recall_at_10, round_even(avg(coalesce(1.0::DOUBLE / rank, 0)), 3) AS mrr FROM r GROUP BY GROUPING SETS ((), (query_type))""")
def retrieval_quality(spark, sf_dir):
    p = _points(spark, sf_dir)
    ranked = ranked_papers(_queries(p), p, 10, skip_own=True)
    return retrieval_metrics(rank_of_source(_sourced(p), ranked))


@query("WITH " + _RANKED.replace("%s", "AND a.vec_id <> b.vec_id AND a.vec_id % 2 = 0") + ", " + _RANKED.replace("%s", "AND a.vec_id <> b.vec_id AND a.vec_id % 2 = 1").replace("hits", "hits2").replace("papers AS", "papers2 AS").replace("FROM papers", "FROM papers2").replace("ranked AS", "ranked2 AS") + """,
r AS (SELECT q.vec_id, EXISTS (SELECT 1 FROM ranked x WHERE x.query_id = q.vec_id AND x.paper_id = q.vec_id // 10) AS a, EXISTS (SELECT 1 FROM ranked2 x WHERE x.query_id = q.vec_id AND x.paper_id = q.vec_id // 10) AS b FROM embeddings q WHERE q.vec_id % 25 = 0)
SELECT count(*) FILTER (a AND b) AS both, count(*) FILTER (a AND NOT b) AS a_only, count(*) FILTER (NOT a AND b) AS b_only, count(*) FILTER (NOT a AND NOT b) AS neither,
round_even(count(*) FILTER (a) / greatest(count(*), 1), 3) AS recall_a, round_even(count(*) FILTER (b) / greatest(count(*), 1), 3) AS recall_b FROM r""")
def compare_collections(spark, sf_dir):
    p = _points(spark, sf_dir)
    a, b = (rank_of_source(_sourced(p), ranked_papers(_queries(p), p.where(F.col("point_id") % 2 == r), 10, skip_own=True)).select("query_id", F.col("rank").isNotNull().alias(f"in_{n}")) for r, n in ((0, "a"), (1, "b")))
    return compare(a.join(b, "query_id"))


_PAIRS = f"FROM {_VECS} a, {_VECS} b WHERE a.vec_id < b.vec_id"


@query(f"SELECT a.paper_id, round(avg({_COS}), 6) AS sim {_PAIRS} AND a.paper_id = b.paper_id GROUP BY 1")
def intra_similarity(spark, sf_dir):
    return mean_similarity(_points(spark, sf_dir), "paper_id").select("paper_id", F.round("sim", 6).alias("sim"))


@query(f"SELECT round(avg({_COS}), 6) AS sim {_PAIRS} AND a.paper_id <> b.paper_id")
def inter_similarity(spark, sf_dir):
    return cross_similarity(_points(spark, sf_dir), "paper_id").select(F.round("sim", 6).alias("sim"))


@query(f"SELECT a.label AS section_type, round(avg({_COS}), 6) AS sim {_PAIRS} AND a.label = b.label GROUP BY 1")
def section_clustering(spark, sf_dir):
    return mean_similarity(_points(spark, sf_dir), "section_type").select("section_type", F.round("sim", 6).alias("sim"))


@query(f"""WITH m AS (SELECT round_even((SELECT avg(s) FROM (SELECT avg({_COS}) AS s {_PAIRS} AND a.label = b.label GROUP BY a.label)), 3) AS intra, round_even((SELECT avg({_COS}) {_PAIRS} AND a.label <> b.label), 3) AS inter)
SELECT intra, inter, CASE WHEN inter > 0 THEN round_even(intra / inter, 3) ELSE 'inf'::DOUBLE END AS ratio, CASE WHEN inter > 0 AND intra / inter < 1.2 AND round_even(intra / inter, 3) < 1.2 THEN 'low' WHEN inter > 0 AND round_even(intra / inter, 3) <= 1.5 THEN '' ELSE 'good' END AS label FROM m""")
def separation_ratio(spark, sf_dir):
    p = _points(spark, sf_dir)
    intra = mean_similarity(p, "section_type").agg(F.bround(F.avg("sim"), 3).alias("intra"))
    inter = cross_similarity(p, "section_type").select(F.bround("sim", 3).alias("inter"))
    both = intra.crossJoin(inter).withColumn("ratio", separation(F.col("intra"), F.col("inter")))  # one row each
    return both.withColumn("label", separation_label(F.col("ratio")))


def _staged(spark, sf_dir) -> DataFrame:
    names = F.array(*[F.lit(s) for s in ("discovered", "downloaded", "extracted", "chunked", "embedded", "failed_download")])
    return _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("work_id"), F.element_at(names, (F.col("doc_id") % 6 + 1).cast("int")).alias("stage"))


_STAGED = "(SELECT doc_id AS work_id, ['discovered', 'downloaded', 'extracted', 'chunked', 'embedded', 'failed_download'][doc_id % 6 + 1] AS stage FROM documents)"


@query(f"""WITH c AS (SELECT stage, count(*) AS cnt FROM {_STAGED} GROUP BY 1 UNION ALL SELECT 'total', count(*) FROM documents) SELECT stage, cnt, repeat('#', least(cnt // 100, 50)) AS bar FROM c""")
def stage_progress(spark, sf_dir):
    return progress(_staged(spark, sf_dir))


@query(f"SELECT work_id, stage, (SELECT count(*) FROM {_STAGED} WHERE stage IN ('discovered', 'downloaded', 'extracted', 'chunked')) AS pending FROM {_STAGED} WHERE stage = 'extracted' ORDER BY work_id LIMIT 50")
def pending_work(spark, sf_dir):
    s = _staged(spark, sf_dir)
    return pending(s, "chunked", 50).crossJoin(work_left(s))  # one row


@query(f"SELECT work_id FROM {_STAGED} WHERE stage <> 'embedded'")
def skip_processed(spark, sf_dir):
    s = _staged(spark, sf_dir)
    return unprocessed(s.select("work_id"), s)


@query("SELECT doc_id AS work_id, CASE WHEN doc_id < 600 THEN 'old' ELSE 'new' END AS stage FROM documents WHERE doc_id < 600 OR doc_id >= 500")
def insert_or_ignore_papers(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("work_id"))
    old, new = d.where("work_id < 600").withColumn("stage", F.lit("old")), d.where("work_id >= 500").withColumn("stage", F.lit("new"))
    return insert_or_ignore(old, new.unionByName(new), "work_id")


@query("SELECT vec_id AS point_id, (CASE WHEN vec_id >= 250 THEN 1 ELSE 0 END)::INT AS version FROM embeddings")
def upsert_points(spark, sf_dir):
    p = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("point_id"))
    return upsert(p.where("point_id < 300").withColumn("version", F.lit(0)), p.where("point_id >= 250").withColumn("version", F.lit(1)))


@query("SELECT vec_id AS point_id, vec_id // 10 AS paper_id, (CASE WHEN vec_id // 10 IN (3, 4) THEN 1 ELSE 0 END)::INT AS version FROM embeddings WHERE vec_id // 10 NOT IN (3, 4) OR vec_id % 10 < 5")
def stale_chunk_replace(spark, sf_dir):
    p = _points(spark, sf_dir).select("point_id", "paper_id")
    new = p.where("paper_id in (3, 4) and point_id % 10 < 5").withColumn("version", F.lit(1))
    return replace_papers(p.withColumn("version", F.lit(0)), new).select("point_id", "paper_id", "version")


@query(f"""SELECT work_id, stage, CASE WHEN stage NOT IN ('downloaded', 'extracted', 'chunked') THEN stage WHEN work_id % 5 = 0 OR work_id % 7 = 0 THEN 'failed_' || stage ELSE 'embedded' END AS then FROM {_STAGED}""")
def resume_transitions(spark, sf_dir):
    s = _staged(spark, sf_dir)
    return s.select("work_id", "stage", after_resume(F.col("stage"), F.col("work_id") % 5 != 0, F.col("work_id") % 7 != 0).alias("then"))


# --- the same code as a user calls it, whole


def _full_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("vec_id")
    e = _read(spark, sf_dir, "embeddings")
    return e.select(
        i.alias("point_id"), (i / 10).cast("long").alias("paper_id"), "embedding", (2010 + i % 15).cast("int").alias("year"), (i % 40).cast("int").alias("citation_count"), F.col("label").cast("string").alias("section_type"),
        F.when(i % 3 != 0, F.concat(F.lit("j"), (i % 4).cast("string"))).alias("journal"), F.repeat(F.lit("x"), (i % 50).cast("int")).alias("chunk_text"),
    )


@query(f"""SELECT paper_id, round(s, 6) AS score, section_type AS section_type, coalesce(journal, '') AS journal, year, citation_count FROM (
SELECT paper_id, point_id, s, section_type, journal, year, citation_count FROM (
SELECT a.paper_id, a.vec_id AS point_id, a.label::VARCHAR AS section_type, CASE WHEN a.vec_id % 3 <> 0 THEN 'j' || (a.vec_id % 4) END AS journal, (2010 + a.vec_id % 15)::INT AS year, (a.vec_id % 40)::INT AS citation_count, {_COS} AS s
FROM {_VECS} a, {_VECS} b WHERE b.vec_id = 0 AND 2010 + a.vec_id % 15 BETWEEN 2012 AND 2020 AND a.vec_id % 40 >= 5 AND a.label IN (1, 2, 3) ORDER BY s DESC, point_id LIMIT 50)
QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY s DESC, point_id) = 1) ORDER BY s DESC, point_id LIMIT 10""")
def search_request(spark, sf_dir):
    p = _full_points(spark, sf_dir)
    found = results(search(p, _query_zero(p), Request(10, 2012, 2020, 5, ("1", "2", "3"))))
    return found.select("paper_id", F.round("score", 6).alias("score"), "section_type", "journal", "year", "citation_count")


_SLOTTED = "['abstract', 'methods', 'introduction', 'body_section', 'results', 'conclusion', 'discussion']"
_QTYPES = "['abstract_sentence', 'method_phrase', 'method_phrase', 'method_phrase', 'result_phrase', 'result_phrase', 'result_phrase']"


@query(rf"""WITH c AS (SELECT doc_id AS point_id, doc_id // 10 AS paper_id, (doc_id * 3 % 8 + 1)::INT AS slot, text, CASE WHEN doc_id // 10 % 5 = 0 THEN '' ELSE source END AS title FROM documents),
titles AS (SELECT paper_id, 0::INT AS slot, 'title' AS query_type, title AS query_text FROM c QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY point_id) = 1),
s AS (SELECT paper_id, point_id, slot, unnest({_SENTENCES}) AS s FROM c WHERE slot <= 7),
own AS (SELECT paper_id, slot, {_QTYPES}[slot] AS query_type, s AS query_text FROM s WHERE length(s) BETWEEN 40 AND 200 AND NOT regexp_matches(s, '\[\d+\]') AND NOT regexp_matches(s, '[{{}}=]') AND NOT contains(s, 'http')
QUALIFY row_number() OVER (PARTITION BY paper_id, slot ORDER BY point_id, sha1('42:' || paper_id || ':' || slot || ':' || s), s) = 1)
SELECT * FROM (SELECT * FROM titles UNION ALL SELECT * FROM own) WHERE paper_id IN (SELECT paper_id FROM titles WHERE query_text <> '') QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY slot) <= 3""")
def benchmark_queries_by_priority(spark, sf_dir):
    i = F.col("doc_id")
    types = F.array(*[F.lit(x) for x in ("abstract", "methods", "introduction", "body_section", "results", "conclusion", "discussion", "references")])
    d = _spread(_read(spark, sf_dir, "documents"))
    chunks = d.select(i.alias("point_id"), (i / 10).cast("long").alias("paper_id"), F.element_at(types, (i * 3 % 8 + 1).cast("int")).alias("section_type"), F.col("text").alias("chunk_text"), F.when((i / 10).cast("long") % 5 == 0, "").otherwise(F.col("source")).alias("title"))
    return benchmark_queries(chunks, 3)


@query("""SELECT 'W' || doc_id AS work_id, n_chars::INT AS citation_count FROM documents WHERE lang = 'en' AND 2010 + doc_id % 15 >= 2015 AND n_chars >= 10 AND doc_id % 11 <> 10 AND (doc_id % 2 = 0 OR doc_id % 5 <> 0) ORDER BY n_chars DESC, work_id LIMIT 50""")
def discover_max_papers(spark, sf_dir):
    return discover(_works(spark, sf_dir), Criteria(max_papers=50)).select("work_id", "citation_count")


@query("""SELECT count(*) AS papers FROM documents WHERE lang = 'en' AND 2010 + doc_id % 15 >= 2015 AND n_chars >= 10 AND (doc_id % 4 <> 3 OR doc_id % 2 = 0 OR doc_id % 5 <> 0)""")
def discover_estimate(spark, sf_dir):
    return spark.createDataFrame([(estimate(_works(spark, sf_dir)),)], "papers long")


@query("""SELECT doc_id::VARCHAR AS paper_id, '2_results' AS section_key, 'results' AS section_type, 0::INT AS section_order, source || '  ' || lang || ' , tail  Nested ' || lang AS content FROM documents
UNION ALL SELECT doc_id::VARCHAR, 'section_1', 'body_section', 1::INT, lang FROM documents
UNION ALL SELECT doc_id::VARCHAR, 'references', 'references', 2::INT, lang || chr(10) || source FROM documents""")
def tei_nested(spark, sf_dir):
    """Sections of elements within elements, 2,000 of them in one."""
    d = _spread(_read(spark, sf_dir, "documents")).select("doc_id", *[F.regexp_replace(c, "[^A-Za-z0-9 ._-]", "").alias(c) for c in ("source", "lang")])
    deep, up = F.repeat(F.lit("<hi>"), 2000), F.repeat(F.lit("</hi>"), 2000)
    tei = F.concat(
        F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body>own<div>lead<head n="2">Results</head><p>'), F.col("source"), F.lit(" <ref>"), F.col("lang"), F.lit("</ref>, tail<lb/></p>after<div><head>Nested</head><p>"), deep, F.col("lang"), up,
        F.lit("</p></div></div><p>no division</p><div><p>"), F.col("lang"), F.lit("</p></div></body><back><div><listBibl><biblStruct><analytic><title>"), F.col("lang"), F.lit("</title></analytic><monogr><title>other</title></monogr></biblStruct><biblStruct><title>"), F.col("source"), F.lit("</title></biblStruct></listBibl></div></back></text></TEI>"),
    )
    return extract(d.select(F.col("doc_id").alias("paper_id"), tei.alias("tei"))).select("paper_id", "section_key", "section_type", "section_order", "content")


@query("SELECT vec_id // 10 AS paper_id, vec_id AS point_id FROM embeddings WHERE vec_id // 10 IN (SELECT DISTINCT vec_id // 10 AS p FROM embeddings ORDER BY p LIMIT 20) QUALIFY row_number() OVER (PARTITION BY vec_id // 10 ORDER BY vec_id) <= 4")
def sample_of_chunks(spark, sf_dir):
    return sample_chunks(_points(spark, sf_dir), 20, 4).select("paper_id", "point_id")


_SAMPLE = "(SELECT * FROM {v} WHERE paper_id IN (SELECT DISTINCT vec_id // 10 AS p FROM embeddings ORDER BY p LIMIT 30) QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY vec_id) <= 8)".format(v=_VECS)


@query(f"""WITH s AS {_SAMPLE}, l AS (SELECT vec_id % 50 AS n FROM s),
m AS (SELECT round_even((SELECT avg(x) FROM (SELECT avg({_COS}) AS x FROM s a, s b WHERE a.vec_id < b.vec_id AND a.paper_id = b.paper_id GROUP BY a.paper_id)), 3) AS intra, round_even((SELECT avg({_COS}) FROM s a, s b WHERE a.vec_id < b.vec_id AND a.paper_id <> b.paper_id), 3) AS inter)
SELECT (SELECT count(DISTINCT paper_id) FROM s) AS total_papers, (SELECT count(*) FROM s) AS total_chunks, round_even((SELECT avg(n) FROM l), 1) AS avg_len, round_even((SELECT quantile_cont(n, 0.5) FROM l), 1) AS median_len, round_even((SELECT quantile_cont(n, 0.05) FROM l), 1) AS p5_len,
round_even((SELECT quantile_cont(n, 0.95) FROM l), 1) AS p95_len, intra AS intra_similarity, inter AS inter_similarity, CASE WHEN inter > 0 THEN round_even(intra / inter, 3) ELSE 'inf'::DOUBLE END AS separation_ratio FROM m""")
def intrinsic_report(spark, sf_dir):
    return Evaluation(_full_points(spark, sf_dir)).intrinsic(30, 8)[0].drop("label")


@query(f"""WITH s AS {_SAMPLE}, near AS (SELECT a.label, avg({_COS}) AS x FROM s a, s b WHERE a.vec_id < b.vec_id AND a.label = b.label GROUP BY 1)
SELECT label::VARCHAR AS section_type, round_even(avg(vec_id % 50), 1) AS avg_len, round_even(any_value(x), 3) AS similarity FROM s LEFT JOIN near USING (label) GROUP BY label""")
def intrinsic_by_section(spark, sf_dir):
    return Evaluation(_full_points(spark, sf_dir)).intrinsic(30, 8)[1]


def _own_queries(points: DataFrame) -> DataFrame:
    return _sourced(points).join(_queries(points), "query_id")


@query("WITH " + _RANKED.replace("%s", "") + """, r AS (SELECT EXISTS (SELECT 1 FROM ranked x WHERE x.query_id = q.vec_id AND x.paper_id = q.vec_id // 10) AS a FROM embeddings q WHERE q.vec_id % 25 = 0)
SELECT NULL::BIGINT AS both, NULL::BIGINT AS a_only, NULL::BIGINT AS b_only, NULL::BIGINT AS neither, round_even(count(*) FILTER (a) / greatest(count(*), 1), 3) AS recall_a, NULL::DOUBLE AS recall_b FROM r""")
def compare_other_width(spark, sf_dir):
    """The other collection has vectors of another width: only the first one's recall is known."""
    p = _full_points(spark, sf_dir)
    return Evaluation(p).comparison(_own_queries(p), p.withColumn("embedding", F.slice("embedding", 1, 8)))[0]


@query("""SELECT vec_id AS point_id, (CASE WHEN vec_id % 4 = 0 THEN vec_id // 10 ELSE vec_id // 5 END)::VARCHAR AS paper_id FROM embeddings WHERE vec_id % 4 <> 3""")
def abstract_paper_ids(spark, sf_dir):
    i = F.col("vec_id")
    e = _read(spark, sf_dir, "embeddings")
    given = F.when(i % 4 == 0, F.concat(F.lit("https://x.org/"), (i / 10).cast("long").cast("string"))).when(i % 4 == 1, "")
    work = F.when(i % 4 == 3, "https://x.org/").otherwise((i / 5).cast("long").cast("string"))
    return named(e.select(i.alias("point_id"), given.alias("paper_id"), work.alias("work_id"), "embedding")).select("point_id", "paper_id")


@query(f"""SELECT 1::BIGINT AS id, count(*) FILTER (stage = 'embedded') AS papers_processed, count(*) FILTER (stage LIKE 'failed%') AS papers_failed, '{{"max_papers": 5}}' AS config FROM {_STAGED}
UNION ALL SELECT 2::BIGINT, NULL::BIGINT, NULL::BIGINT, '{{}}'""")
def run_log(spark, sf_dir):
    s = _staged(spark, sf_dir)
    runs, first = run_started(spark.createDataFrame([], RUNS), {"max_papers": 5})
    done = outcome(s, s.select("work_id")).first()
    runs, _ = run_started(run_ended(runs, first, done["papers_processed"], done["papers_failed"]))
    return runs.select("id", "papers_processed", "papers_failed", "config")


@query(_CHUNKED + "SELECT count(DISTINCT paper_id) AS sections_chunked, count(*) AS total_chunks FROM chunks")
def run_counters(spark, sf_dir):
    d = _spread(_read(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"), "text"))
    return chunk_counters(chunk(d, ["paper_id"], "text"), ["paper_id"])


@query("SELECT turn AS point_id, text AS chunk_text FROM conversations WHERE conv_id = 7 ORDER BY turn LIMIT 3")
def paper_scroll_capped(spark, sf_dir):
    c = _read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("paper_id"), F.col("turn").alias("point_id"), F.col("text").alias("chunk_text"))
    return paper_scroll(c, 7, 3).select("point_id", "chunk_text")


@query("SELECT doc_id::VARCHAR AS work_id, source AS title, (2010 + doc_id % 15)::INT AS year FROM documents")
def state_metadata(spark, sf_dir):
    i = F.col("doc_id")
    papers = _read(spark, sf_dir, "documents").select(i.cast("string").alias("work_id"), F.col("source").alias("title"), (2010 + i % 15).cast("int").alias("year"))
    return metadata(registered(spark.createDataFrame([], STATE), papers), "title string, year int")


@query("SELECT vec_id AS point_id, (CASE WHEN vec_id % 3 = 0 THEN 2 WHEN vec_id >= 250 THEN 1 ELSE 0 END)::INT AS version FROM embeddings WHERE vec_id < 300 OR vec_id >= 250 OR vec_id % 3 = 0")
def upsert_last_wins(spark, sf_dir):
    """Keys repeated within the new rows: the last counts."""
    p = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("point_id"))
    new = p.where("point_id >= 250").withColumn("version", F.lit(1)).unionByName(p.where("point_id % 3 = 0").withColumn("version", F.lit(2)))
    return upsert(p.where("point_id < 300").withColumn("version", F.lit(0)), new, order="version")
