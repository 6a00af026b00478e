"""Passages that repeat across documents, through compact windows (operator 5).

Tokens are the five-word shingles of a text. For one hash function a compact window stands for all subsequences of
SPAN tokens whose least hash is at one place c: a node of the Cartesian tree over the hashes, with the range of starts
lo..hi for which it is the least. The windows of FUNCTIONS functions are joined on their intervals: where all of them
overlap, the subsequences share a signature, the values at their places, which is the key that texts meet by. SPAN is
the longest run of equal tokens that any two similar passages of the least length must have, whatever words were
changed, put in or left out, so that such passages share the signatures of that run.

Texts of the same words are one, known by a hash. The members of a key are held against its first document: the two
texts are aligned from c on, over gaps where words differ, and the longest stretch around c of at least ``least`` tokens
whose Jaccard similarity, taken exactly, is high enough is kept. A member without one says where it leaves that
document and by which token; members that leave it alike meet again under that key, with a representative of their
own, until no key has members that are apart. So a passage within a more common one is found as well, and a group of
any size costs rows in proportion to it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import bloom, maybe, only
from .shared import forget, fresh, table, written
from .tokens import U, mix, shingles, slices, words

SHINGLE, LEAST_WORDS, SIMILARITY = 5, 50, 0.8
FUNCTIONS = 2
_SEEDS = mix(np.arange(1, FUNCTIONS + 1, dtype=np.uint64) * U(0x9FB21C651E98DF25))
#: Tokens of texts that a task keeps for the next pairs.
KEPT = 1 << 21
#: Rows that a task gives at once, about.
ROWS = 20_000
#: Pairs of texts that are verified at once within a task.
PAIRS = 256
#: Words of texts, counted for each place in them, from which on the members left meet in one job instead of one a round.
FEW = 1 << 25


def equal_run(least: int, similarity: float) -> int:
    """The longest run of equal tokens that two passages of ``least`` tokens or more and of that similarity must share.

    A changed word takes SHINGLE tokens of either side. Passages with e changes have at least e * SHINGLE * (1 + s) / (1 - s)
    tokens, of which e * SHINGLE differ, and the others make e + 1 runs.
    """
    best = least
    for changes in range(1, 1000):
        if similarity >= 1:
            break
        tokens = max(least, math.ceil(changes * SHINGLE * (1 + similarity) / (1 - similarity)))
        if changes * SHINGLE * (1 + similarity) / (1 - similarity) <= tokens:
            best = min(best, -(-(tokens - changes * SHINGLE) // (changes + 1)))
    return max(1, best)


def compact_windows(hashes: np.ndarray, ends: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lo, hi, c) of all compact windows, in order: of subsequences of ``span`` tokens that begin in lo..hi, the least hash is at c, the first of equal ones.

    ``ends`` has, for every token, the end of its text; no subsequence crosses it. These are the nodes of the Cartesian
    tree over at least ``span`` tokens; sliding minima find them in time linear in the tokens, whatever they are.
    """
    n = len(hashes)
    if n < span:
        none = np.empty(0, np.int64)
        return none, none, none
    place = U((1 << n.bit_length()) - 1)  # a token's place follows its hash, so that the first of equal ones is the least
    full = np.full(-(-n // span) * span, ~U(0))
    full[:n] = (hashes & ~place) | np.arange(n, dtype=np.uint64)
    blocks = full.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (np.minimum(behind[: n - span + 1], ahead[span - 1 : n]) & place).astype(np.int64)
    starts = np.flatnonzero(np.arange(n - span + 1) + span <= ends[: n - span + 1])
    at = at[starts]
    first = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(starts, prepend=-2) != 1))
    last = np.append(first[1:], len(starts))[: len(first)] - 1
    return starts[first], starts[last], at[first]


def interval_join(windows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(first start, places of each function) of every range of starts in which windows of all functions overlap.

    Each function's windows cover the same starts once, so a range begins where any window does.
    """
    begin = reduce(np.union1d, [lo for lo, _, _ in windows])
    return begin, [c[np.searchsorted(lo, begin, "right") - 1] for lo, _, c in windows]


def signatures(hashes: np.ndarray, rows: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, place in the row, end of the row's tokens) of the signatures of texts; their word hashes are cut at ``rows``.

    Consecutive equal keys of a text, as periodic ones have, are given once.
    """
    tokens = shingles(hashes, SHINGLE) if len(hashes) >= SHINGLE else hashes[:0]
    ends = np.repeat(rows[1:], np.diff(rows))[: len(tokens)] - SHINGLE + 1
    begin, places = interval_join([compact_windows(mix(tokens ^ seed), ends, span) for seed in _SEEDS])
    key = np.zeros(len(begin), dtype=np.uint64)
    for k, c in enumerate(places):
        key = mix(key ^ (tokens[c] + U(k + 1)))
    row = np.searchsorted(rows, begin, "right") - 1
    new = np.ones(len(row), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return row[new], key[new].view(np.int64), places[0][new] - rows[row[new]], tokens


def _keyed(span: int, least_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, rows = words(part.column("text"))
                size = np.diff(rows)
                at = np.arange(len(hashes)) - np.repeat(rows[:-1], size)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ mix(at.astype(np.uint64) + U(1))))])
                row, key, _, _ = signatures(hashes, rows, span)
                long = size[row] >= least_words
                row, key = row[long], key[long]
                ends = np.searchsorted(row, np.arange(part.num_rows + 1))
                columns = [part.column("doc_id"), pa.array(size, pa.int64()), pa.array((sums[rows[1:]] - sums[rows[:-1]]).view(np.int64)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(key))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "same", "keys"])

    return run


def _asking(bits):
    """(doc_id, n_words, same) of the texts that may share a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("keys")
            row = np.repeat(np.arange(batch.num_rows), np.diff(keys.offsets.to_numpy()))
            keep = np.zeros(batch.num_rows, dtype=bool)
            keep[row[maybe(bits.value, keys.flatten().to_numpy(zero_copy_only=False))]] = True
            if keep.any():
                yield batch.select(["doc_id", "n_words", "same"]).filter(pa.array(keep))

    return run


def _placed(bits, docs_bits, span: int, least_words: int):
    """(key, doc_id, c) of the signatures that may be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in only("doc_id", docs_bits)(batches):
            for part in slices(batch, "text"):
                hashes, rows = words(part.column("text"))
                row, key, c, _ = signatures(hashes, rows, span)
                keep = maybe(bits.value, key) & (np.diff(rows)[row] >= least_words)
                if keep.any():
                    docs = part.column("doc_id").to_numpy(zero_copy_only=False)
                    yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(docs[row[keep]], pa.int64()), pa.array(c[keep])], names=["key", "doc_id", "c"])

    return run


def _equal(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common start."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        odd = np.flatnonzero(a[at : min(at + step, n)] != b[at : min(at + step, n)])
        if len(odd):
            return at + int(odd[0])
        at, step = at + step, 4 * step
    return n


def _again(a: np.ndarray, b: np.ndarray, most: int) -> tuple[int, int] | None:
    """(tokens of a, tokens of b) to leave out, as few as can be and at most ``most``, before both have an equal token."""
    reach = 32
    while True:
        reach = min(reach, most)
        p, q = a[: reach + 1], b[: reach + 1]
        if reach <= 64:
            x, y = np.nonzero(p[:, None] == q[None, :])
        else:
            _, x, y = np.intersect1d(p, q, return_indices=True)
        if len(x):
            k = int((x + y).argmin())
            if x[k] + y[k] <= reach:
                return int(x[k]), int(y[k])
        if reach >= most:
            return None
        reach *= 4


def _chain(a: np.ndarray, b: np.ndarray, shared: int, least: int, similarity: float) -> np.ndarray:
    """Rows (tokens of a, tokens of b, equal tokens) of the runs from the start of both on, each with those before it.

    ``shared`` equal tokens are known elsewhere. A gap is followed if a stretch with fewer than ``least`` equal tokens
    beyond it can be similar enough; one with more is found from its own places.
    """
    x = y = equal = 0
    out = [(0, 0, 0)]
    while True:
        n = _equal(a[x:], b[y:])
        x, y, equal = x + n, y + n, equal + n
        if n:
            out.append((x, y, equal))
        room = int((1 / similarity - 1) * (shared + equal + least) - (x + y - 2 * equal))
        gap = _again(a[x:], b[y:], room) if room > 0 else None
        if gap is None:
            return np.array(out)
        x, y = x + gap[0], y + gap[1]


def _similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    own, other = np.unique(a), np.unique(b)
    both = len(np.intersect1d(own, other, assume_unique=True))
    return both >= similarity * (len(own) + len(other) - both)


def aligned(a: np.ndarray, b: np.ndarray, at: int, to: int, least: int, similarity: float) -> tuple[tuple[int, int], tuple[int, int], bool]:
    """(from, to) in a and in b of the longest stretch around the common place that is similar enough, words put in or left out, and True; of the equal run around it and False if there is none.

    Stretches begin and end with equal tokens. Their two sides are chosen together: for each end on the left the farthest
    on the right with which both texts have ``least`` tokens and enough of them are equal, the longest such stretch first.
    """
    if a[at] != b[to]:
        return (at, at + 1), (to, to + 1), False
    back, ahead = a[:at][::-1], b[:to][::-1]
    before, after = _equal(back, ahead), _equal(a[at:], b[to:])
    run = (at - before, at + after), (to - before, to + after)
    left = _chain(back, ahead, after, least, similarity)
    right = _chain(a[at:], b[to:], int(left[-1, 2]), least, similarity)[1:]
    tries = []
    for u, v, equal in left.tolist():  # one side at a time, so that memory is linear
        p, q, e = u + right[:, 0], v + right[:, 1], equal + right[:, 2]
        fit = np.flatnonzero((np.minimum(p, q) >= least) & (e >= similarity * (p + q - e)))
        if len(fit):
            j = fit[(p + q)[fit].argmax()]
            tries.append((int(p[j] + q[j]), u, v, int(right[j, 0]), int(right[j, 1]), bool(p[j] == q[j] == e[j])))
    for _, u, v, x, y, equal in sorted(tries, reverse=True):
        mine, yours = (at - u, at + x), (to - v, to + y)
        if equal or _similar(a[slice(*mine)], b[slice(*yours)], similarity):
            return mine, yours, True
    return *run, False


def _hashed(*facts: int) -> int:
    """A signed 64-bit hash of integers."""
    x = 0
    for f in facts:
        x = (x ^ f & 0xFFFFFFFFFFFFFFFF) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
        x = (x ^ x >> 29) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
        x ^= x >> 32
    return x - (x >> 63 << 64)


def _partings(length: int, run: tuple[int, int], sides: tuple[bool, bool]) -> list[tuple[int, int]]:
    """(side, place) of the tokens at which a text leaves another: just beyond their equal run, and beyond one changed word."""
    out = [(side, pos) for side, pos in ((0, run[0] - 1), (0, run[0] - 1 - SHINGLE), (1, run[1]), (1, run[1] + SHINGLE))]
    return [(side, pos) for side, pos in out if sides[side] and 0 <= pos < length]


def _verified(least: int, similarity: float, first: bool):
    """For pairs of texts and their common places: the stretches that they share, both texts' sides of them, and where the first leaves the second.

    Rows are (kind, doc_id, x, y, other): kind 0, a stretch from x to y that other has too; kind 1, key x and place y of a
    parting. In the ``first`` round the key is where the second text is left and by which token, and the place is that
    token's: what leads there does not matter. Later it is made of the key that led there, how far on the texts part and by which token,
    and the place stays: members of such a key share ever longer runs around it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}

        def tokens(doc: int, texts: pa.Array, i: int) -> np.ndarray:
            if doc not in kept:
                if sum(map(len, kept.values())) > KEPT:
                    kept.clear()
                kept[doc] = shingles(words(texts.slice(i, 1))[0], SHINGLE)
            return kept[doc]

        def rows(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), (pa.int32(), *[pa.int64()] * 4), strict=True)], names=["kind", "doc_id", "x", "y", "other"])

        for batch in batches:
            out: list[tuple] = []
            for i, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)):
                if len(out) > ROWS:
                    yield rows(out)
                    out = []
                right = tokens(b, batch.column("tb"), i)
                left = right if a == b else shingles(words(batch.column("ta").slice(i, 1))[0], SHINGLE)
                spots = batch.column("places")[i].values
                at, to, keys = (spots.field(c).to_numpy(zero_copy_only=False) for c in ("ca", "cb", "key"))
                held = (at < len(left)) & (to < len(right))  # rows may share a doc_id
                order = np.lexsort((at[held], (at - to)[held]))
                at, shift, keys = at[held][order], (at - to)[held][order], keys[held][order]
                covered = np.zeros(len(left), dtype=bool)
                cut = np.flatnonzero(np.diff(shift, prepend=shift[:1] - 1))
                groups = zip(cut.tolist(), [*cut[1:].tolist(), len(at)], strict=True)
                for x, y in sorted(groups, key=lambda g: g[0] - g[1]):  # the shift that most places ask for first
                    move, todo = int(shift[x]), np.arange(x, y)
                    while len(todo := todo[~covered[at[todo]]] if a != b else todo):
                        here = int(at[todo[0]])
                        good, sides = False, (True, True)
                        if a == b:  # other places in the representative: they only part from its first, if they do so where it matters
                            there, far = here - move, 2 * least
                            n = _equal(left[max(0, here - far) : here][::-1], right[max(0, there - far) : there][::-1])
                            m = _equal(left[here : here + far], right[there : there + far])
                            mine, sides = (here - n, here + m), (n < far, m < far)
                        else:
                            mine, yours, good = aligned(left, right, here, here - move, least, similarity)
                        if good:
                            covered[slice(*mine)] = True
                            out += [(0, a, mine[0], mine[1] + SHINGLE - 1, b), (0, b, yours[0], yours[1] + SHINGLE - 1, a)]
                        elif first:
                            out += [(1, a, _hashed(b, pos - move, side, int(left[pos])), pos, b) for side, pos in _partings(len(left), mine, sides)]
                        else:
                            inside = todo[at[todo] < max(mine[1], here + 1)]
                            out += [(1, a, _hashed(int(keys[k]), pos - int(at[k]), side, int(left[pos])), int(at[k]), b) for side, pos in _partings(len(left), mine, sides) for k in inside]
                        todo = todo[at[todo] >= max(mine[1], here + 1)]
            if out:
                yield rows(out)

    return run


def _settled(least: int, similarity: float):
    """For places of keys with their texts, (key, doc_id, c, text) in order of the keys: the stretches of all rounds to come.

    A later key is made of the one that led there, so members of different keys never meet again.
    """
    verify = _verified(least, similarity, False)

    def pairs(places: set[tuple[int, int, int]], texts: dict[int, dict[str, None]]) -> Iterator[pa.RecordBatch]:
        lead: dict[int, tuple[int, int]] = {}
        last: dict[int, int] = {}
        for key, doc, c in places:
            lead[key] = min(lead.get(key, (doc, c)), (doc, c))
            last[key] = max(last.get(key, doc), doc)
        met: dict[tuple[int, int], list[dict[str, int]]] = {}
        for key, doc, c in sorted(places):
            b, cb = lead[key]
            if b != last[key] and (doc, c) != (b, cb):
                met.setdefault((doc, b), []).append({"ca": c, "cb": cb, "key": key})
        rows = [(a, b, met[a, b], ta, tb) for a, b in sorted(met) for ta in texts[a] for tb in texts[b]]
        spots = pa.list_(pa.struct([("ca", pa.int64()), ("cb", pa.int64()), ("key", pa.int64())]))
        for k in range(0, len(rows), PAIRS):
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows[k : k + PAIRS], strict=True), (pa.int64(), pa.int64(), spots, pa.string(), pa.string()), strict=True)], names=["a", "b", "places", "ta", "tb"])

    def settle(places: set[tuple[int, int, int]], texts: dict[int, dict[str, None]]) -> Iterator[pa.RecordBatch]:
        while places:
            left: set[tuple[int, int, int]] = set()
            for out in verify(pairs(places, texts)):
                parted = out.column("kind").to_numpy() == 1
                left.update(zip(*(out.column(c).to_numpy()[parted].tolist() for c in ("x", "doc_id", "y")), strict=True))
                if not parted.all():
                    yield out.filter(pa.array(~parted))
            places = left

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: set[tuple[int, int, int]] = set()
        texts: dict[int, dict[str, None]] = {}
        size, last = 0, None
        for batch in batches:
            for k, (key, doc, c) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("key", "doc_id", "c")), strict=True)):
                if key != last and size > KEPT:
                    yield from settle(places, texts)
                    places, texts, size = set(), {}, 0
                last, text = key, batch.column("text")[k].as_py()
                if text is not None and text not in texts.setdefault(doc, {}):
                    texts[doc][text] = None
                    size += len(text)
                places.add((key, doc, c))
        yield from settle(places, texts)

    return run


def repeats(docs: DataFrame, least_words: int = LEAST_WORDS, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Passages of at least ``least_words`` words that another document repeats.

    Returns (sizes, spans): sizes is (doc_id, n_words), a row for every row of ``docs`` (doc_id and text); spans is
    (doc_id, start, end, first): words start..end-1 of the document stand, at a similarity of five-word shingles of
    ``similarity`` or more, in other documents too, and first is the smallest doc_id that such a stretch was verified
    in, its own included. Spans may overlap. Null and short texts have none, and so has an empty table. Rows that share
    a doc_id are one document; rows without doc_id are left out of the search. Repeats within one document alone are no
    repeats. Other columns are not read.
    """
    least = max(1, least_words - SHINGLE + 1)
    span = equal_run(least, similarity)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = written(base.mapInArrow(_keyed(span, least_words), "doc_id long, n_words long, same long, keys array<long>"), "signatures")
    sizes = written(keyed.select("doc_id", "n_words", "same"), "sizes")
    long = sizes.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words))
    texts = written(long.groupBy("same", "n_words").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")), "texts")

    entries = keyed.where("doc_id is not null").select("same", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.min("same").alias("lo"), F.max("same").alias("hi")).where("lo <> hi").select("key")
    bits = bloom(shared)
    asking = keyed.where("doc_id is not null").mapInArrow(_asking(bits), "doc_id long, n_words long, same long")
    asking = written(asking.join(texts.select("same", "n_words", "lo"), ["same", "n_words"]).where("doc_id = lo").select("doc_id").distinct(), "asking")
    own = base.where("doc_id is not null")
    members = written(own.mapInArrow(_placed(bits, bloom(asking), span, least_words), "key long, doc_id long, c long"), "places")
    forget(keyed, asking)

    found = []
    while True:
        ends = members.groupBy("key").agg(F.min(F.struct("doc_id", "c")).alias("rep"), F.max("doc_id").alias("hi")).where("rep.doc_id <> hi")
        ends = written(ends.select("key", F.col("rep.doc_id").alias("b"), F.col("rep.c").alias("cb")), "representatives")
        if found:
            again = members.join(ends.select("key"), "key")
            if (again.join(sizes.select("doc_id", "n_words"), "doc_id").agg(F.sum("n_words")).first()[0] or 0) <= FEW:
                texts_of = own.mapInArrow(only("doc_id", bloom(again.select("doc_id"))), base.schema)
                rest = again.join(texts_of, "doc_id").select("key", "doc_id", "c", "text").repartition("key").sortWithinPartitions("key")
                found.append(written(rest.mapInArrow(_settled(least, similarity), "kind int, doc_id long, x long, y long, other long"), "found"))
                forget(members, ends)
                break
        by = F.lit(0).cast("long") if not found else F.col("key")  # in the first round, places that several keys lead to are one
        met = members.join(ends, "key").where("doc_id <> b or c <> cb").select(F.col("doc_id").alias("a"), "b", F.col("c").alias("ca"), "cb", by.alias("key")).distinct()
        pairs = written(met.groupBy("a", "b").agg(F.collect_list(F.struct("ca", "cb", "key")).alias("places")), "pairs")  # at most the places of a text
        forget(members, ends)
        if pairs.isEmpty():
            forget(pairs)
            break
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        needed = own.mapInArrow(only("doc_id", bloom(ids)), base.schema)
        both = pairs.join(needed.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").join(needed.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        found.append(written(both.select("a", "b", "places", "ta", "tb").mapInArrow(_verified(least, similarity, not found), "kind int, doc_id long, x long, y long, other long"), "found"))
        members = written(found[-1].where("kind = 1").select(F.col("x").alias("key"), "doc_id", F.col("y").alias("c")).distinct(), "places")
        forget(pairs)
    none = docs.sparkSession.createDataFrame([], "kind int, doc_id long, x long, y long, other long")
    parts = reduce(DataFrame.unionByName, found, none).where("kind = 0").groupBy("doc_id", F.col("x").alias("start"), F.col("y").alias("end")).agg(F.least(F.min("other"), F.col("doc_id")).alias("first"))
    whole = long.join(texts.where("lo <> hi"), ["same", "n_words"]).select("doc_id", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"), F.col("lo").alias("first")).distinct()
    spans = written(parts.unionByName(whole), "spans")
    forget(*found, texts)
    return sizes.select("doc_id", "n_words"), spans


def merged(spans: DataFrame) -> DataFrame:
    """(doc_id, spans): each document's spans as sorted disjoint (start, end)."""
    got = spans.select("doc_id", "start", "end").distinct().groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("s"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(acc, x):
        joins = (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] >= x["start"])
        return F.when(joins, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.least(F.get(acc, F.size(acc) - 1)["start"], x["start"]).alias("start"), F.greatest(F.get(acc, F.size(acc) - 1)["end"], x["end"]).alias("end"))))).otherwise(F.concat(acc, F.array(x)))

    return got.select("doc_id", F.aggregate("s", empty, add).alias("spans"))


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """The rows and columns of ``docs``; of each repeated passage all words go but in the smallest doc_id that has it.

    The words that stay of a text that loses any are joined by single spaces. Null texts stay null; rows that share a doc_id
    lose the same places, and rows without one nothing; extra columns stay, and an empty table stays empty.
    """
    _, spans = repeats(docs, **options)
    drop, key = fresh(docs, "drop", "key")
    gone = merged(spans.where("first < doc_id")).select(F.col("doc_id").alias(key), F.col("spans").alias(drop))
    bare = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    kept = F.filter(bare, lambda w, i: ~F.exists(drop, lambda s: (s["start"] <= i) & (i < s["end"])))
    text = F.when(F.col(drop).isNull(), F.col("text").cast("string")).otherwise(F.array_join(kept, " "))
    return docs.join(gone, docs["doc_id"].cast("long") == F.col(key), "left").withColumn("text", text).select(*docs.columns)


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """The whole of ``documents``: doc_id, n_words, n_repeated (words in repeated passages), first_doc, spans of words."""
    sizes, spans = repeats(table(spark, sf_dir, "documents"))
    firsts = spans.groupBy("doc_id").agg(F.min("first").alias("first"))
    own = merged(spans).join(firsts, "doc_id")
    n = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    shown = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    out = sizes.join(own, "doc_id", "left")
    return out.select("doc_id", "n_words", F.coalesce(n, F.lit(0)).alias("n_repeated"), F.coalesce("first", "doc_id").alias("first_doc"), F.coalesce(shown, F.lit("")).alias("spans"))
