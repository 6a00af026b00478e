"""Documents that hold windows of benchmark items, by a prefix-filtered join with exact verification (operator 9).

A window is contained in a document only if each of its shingles is. Of each window the rarest shingle, in one order
over all benchmark shingles, is its prefix; documents meet windows by prefixes alone. A match places the window:
it must fit between the text's ends, and is then compared word by word.

A benchmark of at most ``BLOCK_WORDS`` words, counted first, is one table of windows that all tasks get. A larger one
stays distributed: its shingles are counted and its windows made by Spark, and the documents' shingles that a Bloom
filter of the prefixes lets through are joined to them, each with the words around it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import bloom, maybe
from .shared import forget, fresh, table, written
from .tokens import ALPHANUMERIC, U, shingles, slices, words

WINDOW, SHINGLE = 13, 3
#: Words of the benchmark that are broadcast at most, about 30 MB with their windows; words of an item that are handled at once.
BLOCK_WORDS, PIECE = 1 << 20, 4096
_FILTER = 1 << 22


def _grams(words: np.ndarray, window: int, shingle: int) -> np.ndarray:
    """The shingles that prefixes of a piece's windows are taken from."""
    return shingles(words, min(shingle, window, len(words)))


def _prefixes(grams: np.ndarray, rarity: np.ndarray, size: int, shingle: int) -> Iterator[tuple[int, int]]:
    """(start, offset of the rarest shingle) of every window of ``size`` words; ties by the hash."""
    width = size - shingle + 1
    for at in range(len(grams) - width + 1):
        own = np.lexsort((grams[at : at + width], rarity[at : at + width]))
        yield at, int(own[0])


class Windows:
    """The windows of some items and the sorted prefixes that lead to them."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int, shingle: int):
        parts = [_grams(w, window, shingle) for _, w in items]
        counts = Counter(int(h) for x in parts for h in x)
        self.items = [i for i, _ in items]
        self.words = np.concatenate([w for _, w in items]) if items else np.empty(0, np.uint64)
        first = np.concatenate([[0], np.cumsum([len(w) for _, w in items])])
        prefix, offset, start, size, item = [], [], [], [], []
        for k, (_, w) in enumerate(items):
            rarity = np.array([counts[int(h)] for h in parts[k]], dtype=np.int64)
            n = min(window, len(w))
            for at, j in _prefixes(parts[k], rarity, n, min(shingle, n)):
                prefix.append(int(parts[k][at + j]))
                offset.append(j)
                start.append(first[k] + at)
                size.append(n)
                item.append(k)
        order = np.argsort(np.array(prefix, dtype=np.uint64), kind="stable")
        self.prefix = np.array(prefix, dtype=np.uint64)[order]
        self.offset, self.start, self.size, self.item = (np.array(x, dtype=np.int64)[order] for x in (offset, start, size, item))
        self.lengths = sorted({min(shingle, n) for n in size})
        self.may = np.zeros(_FILTER, dtype=bool)
        self.may[(self.prefix & U(_FILTER - 1)).astype(np.int64)] = True

    def matches(self, doc: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence in the texts whose words are ``doc``, cut at ``rows``."""
        starts, found = [], []
        for p in self.lengths:
            if len(doc) < p:
                continue
            own = shingles(doc, p)
            at = np.flatnonzero(self.may[(own & U(_FILTER - 1)).astype(np.int64)])
            lo, hi = np.searchsorted(self.prefix, own[at], "left"), np.searchsorted(self.prefix, own[at], "right")
            n = hi - lo
            at = np.repeat(at, n)
            win = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(len(at))
            row = np.searchsorted(rows, at, "right") - 1
            begin = at - self.offset[win]
            fits = (begin >= rows[row]) & (begin + self.size[win] <= rows[row + 1]) & (np.minimum(self.size[win], SHINGLE) == p)
            begin, win = begin[fits], win[fits]
            good = np.ones(len(win), dtype=bool)
            for j in range(int(self.size[win].max()) if len(win) else 0):
                test = np.flatnonzero(good & (self.size[win] > j))
                good[test] = doc[begin[test] + j] == self.words[self.start[win[test]] + j]
            starts.append(begin[good])
            found.append(win[good])
        if not starts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(starts), np.concatenate(found)


def _pieces(window: int):
    """Items as runs of at most ``PIECE`` starts of windows each: (item, at, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text"), strict=True):
                own, _ = words(pa.array([text.as_py()], pa.string()), ALPHANUMERIC)
                out += [(item, at, own[at : at + PIECE + window - 1].tobytes()) for at in range(0, max(len(own) - window, 0) + 1, PIECE) if len(own)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.binary()), strict=True)], names=["item", "at", "words"])

    return run


def _words(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.uint64)


def _counted(window: int, shingle: int):
    """(piece, gram, place) of every shingle of the pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, blob in zip(batch.column("piece").to_pylist(), batch.column("words").to_pylist(), strict=True):
                grams = _grams(_words(blob), window, shingle)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), piece)), pa.array(grams.view(np.int64)), pa.array(np.arange(len(grams)))], names=["piece", "gram", "place"])

    return run


def _windowed(window: int, shingle: int):
    """(prefix, before, bytes, item) of the windows of pieces with their shingles' counts: words before the prefix, and the window's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, blob, counts in zip(batch.column("item").to_pylist(), batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                own = _words(blob)
                grams, n = _grams(own, window, shingle), min(window, len(own))
                rarity = np.zeros(len(grams), dtype=np.int64)
                for c in counts:
                    rarity[c["place"]] = c["n"]
                out += [(int(grams[at + j].view(np.int64)), j, own[at : at + n].tobytes(), item) for at, j in _prefixes(grams, rarity, n, min(shingle, n))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.string()), strict=True)], names=["prefix", "before", "window", "item"])

    return run


def _sized(text: str, n_words: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                _, rows = words(part.column(text), ALPHANUMERIC)
                yield pa.RecordBatch.from_arrays([pa.array(np.diff(rows), pa.int64()) if c == n_words else part.column(c) for c in names], names=names)

    return run


def _around(bits, lengths: list[int], window: int):
    """(mark, prefix, at, ahead, words): shingles that may be prefixes, with the words of the text around them, ``ahead`` of which come before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                doc, rows = words(part.column("text"), ALPHANUMERIC)
                mark = part.column("mark").to_numpy()
                for p in lengths:
                    if len(doc) < p:
                        continue
                    grams = shingles(doc, p).view(np.int64)
                    at = np.flatnonzero(maybe(bits.value, grams))
                    row = np.searchsorted(rows, at, "right") - 1
                    at, row = at[at + p <= rows[row + 1]], row[at + p <= rows[row + 1]]
                    lo, hi = np.maximum(rows[row], at - window), np.minimum(rows[row + 1], at + window)
                    for k in range(0, len(at), 10_000):
                        some = slice(k, k + 10_000)
                        blobs = [doc[a:b].tobytes() for a, b in zip(lo[some], hi[some], strict=True)]
                        columns = [pa.array(mark[row[some]]), pa.array(grams[at[some]]), pa.array(at[some] - rows[row[some]]), pa.array(at[some] - lo[some]), pa.array(blobs, pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, names=["mark", "prefix", "at", "ahead", "words"])

    return run


def _joined(docs: DataFrame, pieces: DataFrame, window: int, names: list[str], keep: list[str]) -> DataFrame:
    """``contamination`` by joins, for a benchmark of any size. Rows of equal text share their hits."""
    text, n_words, n_hit, mark, found = names
    pieces = pieces.withColumn("piece", F.xxhash64("item", "at", "words"))
    grams = written(pieces.select("piece", "words").mapInArrow(_counted(window, SHINGLE), "piece long, gram long, place long"), "grams")
    counts = written(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "gram-counts")
    rare = grams.join(counts, "gram").groupBy("piece").agg(F.collect_list(F.struct("place", "n")).alias("counts"))  # at most PIECE + window
    windows = pieces.join(rare, "piece").select("item", "words", "counts").mapInArrow(_windowed(window, SHINGLE), "prefix long, before int, window binary, item string")
    windows = written(windows.distinct(), "windows")
    lengths = [r[0] for r in windows.select(F.least(F.octet_length("window") / 8, F.lit(SHINGLE)).cast("int")).distinct().collect()]  # SHINGLE at most
    prefixes = windows.select("prefix").distinct()
    asked = docs.select(F.xxhash64(text).alias("mark"), F.col(text).alias("text")).where("text is not null")
    near = asked.mapInArrow(_around(bloom(prefixes), lengths, window), "mark long, prefix long, at long, ahead long, words binary")
    met = near.join(windows, "prefix").where("ahead >= before").where(F.expr("substring(words, int((ahead - before) * 8 + 1), octet_length(window)) = window"))
    hits = written(met.select("mark", (F.col("at") - F.col("before")).alias("at"), (F.octet_length("window") / 8).cast("long").alias("n"), "item").distinct(), "hits")
    covered = hits.select("mark", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("word")).distinct().groupBy("mark").agg(F.count(F.lit(1)).alias("hit"))
    items = hits.select("mark", "item").distinct().groupBy("mark").agg(F.sort_array(F.collect_list("item")).alias("items"))
    own = written(covered.join(items, "mark").select(F.col("mark").alias(mark), F.col("hit").alias(n_hit), F.col("items").alias(found)), "hit-texts")
    forget(grams, counts)
    columns = [*docs.columns, n_words]
    sized = docs.withColumn(n_words, F.lit(0).cast("long"))
    sized = sized.mapInArrow(_sized(text, n_words, columns), sized.schema).withColumn(mark, F.xxhash64(text))
    out = sized.join(own, mark, "left").withColumn(n_hit, F.coalesce(n_hit, F.lit(0).cast("long")))
    return out.select(*keep)


def _marked(block, names: list[str], keep: list[str]):
    """The columns ``keep`` with each text's words, hit words and items, by the windows of ``block``."""
    text, n_words, n_hit, _, found = names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = block.value
        for batch in batches:
            for part in slices(batch, text):
                doc, rows = words(part.column(text), ALPHANUMERIC)
                begin, win = windows.matches(doc, rows)
                depth = np.bincount(begin, minlength=len(doc) + 1) - np.bincount(begin + windows.size[win], minlength=len(doc) + 1)
                hit = np.concatenate([[0], np.cumsum(np.cumsum(depth)[: len(doc)] > 0)])
                items: list = [None] * part.num_rows
                row = np.searchsorted(rows, begin, "right") - 1
                for i, k in np.unique(np.stack([row, windows.item[win]]), axis=1).T.tolist():
                    items[i] = [*(items[i] or ()), windows.items[k]]
                new = {n_words: pa.array(np.diff(rows), pa.int64()), n_hit: pa.array(hit[rows[1:]] - hit[rows[:-1]], pa.int64()), found: pa.array([x and sorted(set(x)) for x in items], pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([new[c] if c in new else part.column(c) for c in keep], names=keep)

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """The rows of ``docs`` (columns ``keep``, all by default) with n_words, n_hit and items, and the names of those three.

    Words are runs of letters, digits and whatever is beyond ASCII, A-Z lower-cased. A window is ``window``
    consecutive words of an item; an item of fewer words is one window, one of none has no windows. n_hit counts the
    words that lie in an occurrence of a window; items are those with such windows, sorted as strings (null: none).
    Null texts have no words; items without id are left out, equal ids count once; repeated rows are found each.
    Extra columns stay, and new names give way to theirs.
    """
    spark = docs.sparkSession
    names = ["text", *fresh(docs, "n_words", "n_hit", "mark", "items")]
    last = [*(docs.columns if keep is None else keep), names[1], names[2], names[4]]
    docs = docs.withColumn("text", F.col("text").cast("string"))
    given = benchmark.where("item_id is not null").select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    pieces = written(given.mapInArrow(_pieces(window), "item string, at long, words binary"), "pieces")
    total = pieces.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0] // 8
    if total > BLOCK_WORDS:
        return _joined(docs, pieces, window, names, last), [names[1], names[2], names[4]]
    rows = pieces.orderBy("item", "at", "words").collect()  # at most BLOCK_WORDS words
    block = spark.sparkContext.broadcast(Windows([(r["item"], _words(bytes(r["words"]))) for r in rows], window, SHINGLE))
    zero = F.lit(0).cast("long")
    out = docs.withColumns({names[1]: zero, names[2]: zero, names[4]: F.lit(None).cast("array<string>")})
    return out.mapInArrow(_marked(block, names, last), out.select(*last).schema), [names[1], names[2], names[4]]


def contaminated(n_words, n_hit):
    """A word is hit, and at least 5% of all words are."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    """The whole of ``documents`` against the whole of ``benchmark``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, (n_words, n_hit, items) = contamination(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    items = F.coalesce(items, F.array().cast("array<string>"))
    return found.select(
        "doc_id",
        n_words,
        n_hit,
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(F.col(n_words), F.col(n_hit)).alias("contaminated"),
    )
