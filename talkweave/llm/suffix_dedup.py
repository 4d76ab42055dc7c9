"""Removal of long repeated byte strings by suffix arrays.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too. Strings are judged on
the input, and never cross documents.

Which strings can be equal at all is found first: every window of ``length`` bytes picks the k-gram of least hash in it
(an anchor), so equal windows have equal anchors. The windows of one anchor make a core. Only cores whose anchor
stands in another place too go on. Cores of equal bytes (by a 128-bit hash) are counted, so a group of copies, however large, costs two
pieces: those of its first and of its last place. All pieces of an anchor meet in one shard, and the shard's suffix array decides
which windows recur; nothing is removed that no array has found twice. Cores of an anchor without other bytes beside them are
joined to runs first, as far as their first and last places run in parallel, so that long copies are not cut into many overlapping pieces.

Suffix arrays are made by induced sorting: suffixes are classified, the substrings between leftmost-smaller (LMS) suffixes
are sorted by induction and named, the string of names is sorted recursively in the same way, and all suffixes are induced from the sorted
LMS suffixes in linear time. Induction goes over several buckets at once as long as none of them induces into another of them. Permuted
common prefixes come from the suffix before each in the array: they are compared only where the preceding bytes differ, and follow
from their neighbour elsewhere.

The pieces of one anchor may be too many for a shard (the edge of a passage in very many contexts). They are then dealt out by window: windows
are counted by 128-bit hash with partial sums, and of those that recur two places each go to a shard, whose suffix array decides as above.

Results for edge cases: a null text counts as empty; texts shorter than ``length`` keep all bytes. Rows are told apart by a
128-bit hash of id and text: rows that repeat an id and text are different places with the same result, so they lose
what is long enough. Null ids are ids like others. A text of any length is one row of its task; its pieces are cut to a bounded
length. An empty table gives an empty one. Other columns are ignored by the digests, and kept by remove_repeats(), whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkweave.llm.common import bounded_batches, free_names, removed, row_hash, shared_dir, stored, table, with_column

LENGTH = 200
GRAM = 64
#: Bytes of pieces that one suffix array takes; the pieces of an anchor that has more are dealt out by window.
SHARD_BYTES = 2 << 20
#: An anchor with more than one in so many of the recurring cores is hot.
HOT_SHARE, HOT_LEAST = 1000, 10_000
#: Runs of cores are cut at multiples of so many bytes.
RUN_BYTES = 1 << 16
SEPARATOR = 0xFF  # no byte of UTF-8


# --- suffix arrays


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Sorted suffixes of a string of small integers, of any alphabet."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    # S: smaller than the next suffix; L: larger. Equal symbols have the type of the next; the last suffix is L.
    step = np.empty(n, np.int8)
    step[:-1] = (s[1:] > s[:-1]).view(np.int8) - (s[1:] < s[:-1]).view(np.int8)
    step[-1] = -1
    decided = np.flatnonzero(step)
    small = np.repeat(step[decided] > 0, np.diff(decided, prepend=-1))
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sizes = np.bincount(s)
    heads = np.concatenate(([0], np.cumsum(sizes)))
    first = np.repeat(np.arange(len(sizes)).astype(s.dtype), sizes)
    if len(lms) > 1:
        order = _induce(s, small, lms, heads, first)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ranked = order[is_lms[order]]
        names = _names(s, lms, ranked)
        lms = lms[suffix_array(names)] if names.max() + 1 < len(lms) else ranked
    return _induce(s, small, lms, heads, first)


def _names(s: np.ndarray, lms: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Numbers for the LMS substrings in order; equal ones get the same. In text order."""
    n = len(s)
    size = np.zeros(n, np.int32)
    size[lms] = np.append(lms[1:], n - 1) - lms + 1  # with the symbol at which the next begins
    a, b = ranked[:-1], ranked[1:]
    same = (size[a] == size[b]) & (a != lms[-1]) & (b != lms[-1])
    todo = np.flatnonzero(same)
    k = 0
    while len(todo):
        equal = s[a[todo] + k] == s[b[todo] + k]
        same[todo[~equal]] = False
        todo = todo[equal]
        k += 1
        todo = todo[size[a[todo]] > k]
    number = np.zeros(n, np.int32)
    number[ranked] = np.concatenate(([0], np.cumsum(~same)))
    return number[lms]


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, heads: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The suffix array from LMS suffixes in order. heads: where each symbol's bucket begins; first: the symbol of each place."""
    n = len(s)
    sa = np.full(n, -1, np.int32)
    c = s[lms]
    by = np.argsort(c, kind="stable")
    c = c[by].astype(np.int64)
    sa[heads[c + 1] - (np.searchsorted(c, c, "right") - np.arange(len(c)))] = lms[by]  # at the ends of their buckets
    at = heads[:-1].copy()
    sa[at[s[-1]]] = n - 1  # the suffix before the end of the string
    at[s[-1]] += 1
    _scan(sa, heads, first, at, s, ~small)
    filled = np.flatnonzero(sa >= 0)
    sa[filled[small[sa[filled]]]] = -1
    # S suffixes are induced from the right: the same, mirrored
    last = first[-1]
    _scan(sa[::-1], n - heads[::-1], (last - first)[::-1], n - heads[:0:-1], last - s, small)
    return sa


def _scan(sa: np.ndarray, heads: np.ndarray, first: np.ndarray, at: np.ndarray, s: np.ndarray, wanted: np.ndarray) -> None:
    """Goes over the array once from the left; each suffix puts the one before it, if wanted, at the next open place (at) of its bucket.
    As many buckets as don't induce into one another are handled at once."""
    n = len(s)
    ramp = np.arange(n)

    def deal(items: np.ndarray, to: np.ndarray) -> None:
        by = to.argsort(kind="stable")
        to = to[by]
        m = len(to)
        fresh = np.empty(m, bool)
        fresh[0] = True
        np.not_equal(to[1:], to[:-1], out=fresh[1:])
        begin = fresh.nonzero()[0]
        count = np.empty(len(begin), np.int64)
        np.subtract(begin[1:], begin[:-1], out=count[:-1])
        count[-1] = m - begin[-1]
        of = to[begin]
        place = at[of]
        sa[(place - begin).repeat(count) + ramp[:m]] = items[by]
        at[of] = place + count

    def induced(part: np.ndarray) -> None:
        items = part[part > 0] - 1
        items = items[wanted[items]]
        if len(items):
            deal(items, s[items])

    p, chunk = 0, 1 << 12
    while p < n:
        c = int(first[p])
        q = int(heads[int(first[min(n, p + chunk) - 1]) + 1])
        slots = sa[p:q]
        use = (slots > 0).nonzero()[0]
        items = slots[use] - 1
        keep = wanted[items]
        items, here = items[keep], first[p:q][use[keep]]
        to = s[items]
        end = int(first[q - 1]) + 1  # buckets below end can be handled
        if len(to):
            low = np.minimum.accumulate(to)
            k = int((low <= here).argmax())
            if low[k] <= here[k]:
                end = int(low[k])
                m = int(np.searchsorted(here[:k], end))
                items, to = items[:m], to[:m]
            else:
                end = min(end, int(low[-1]))
        if end > c:
            if len(to):
                deal(items, to)
            done = int(heads[end])
            chunk = min(1 << 16, 2 * chunk) if done == q else max(64, 2 * (done - p))
            p = done
            continue
        # a bucket that induces into itself, in rounds; then the suffixes at its end
        while p < at[c]:
            part = sa[p : at[c]]
            p = int(at[c])
            induced(part)
        induced(sa[p : heads[c + 1]])
        p = int(heads[c + 1])


def permuted_lcp(b: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position, the position before it in the array (-1: none) and the length of their common prefix."""
    n = len(b)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    pos = np.arange(n)
    reducible = (before > 0) & (pos > 0)
    reducible[reducible] = b[pos[reducible] - 1] == b[before[reducible] - 1]
    # a reducible position's prefix is one less than its left neighbour's, if both pairs are neighbours in the array
    reducible[1:] &= before[1:] == before[:-1] + 1
    heads = np.flatnonzero(~reducible)
    size = np.zeros(len(heads), np.int64)
    todo = np.flatnonzero(before[heads] >= 0)
    words = np.zeros(n + 8, np.uint64)
    padded = np.concatenate((b, np.zeros(16, np.uint8))).astype(np.uint64)
    for j in range(8):
        words |= padded[j : n + 8 + j] << np.uint64(8 * j)
    i, j = heads[todo], before[heads[todo]]
    k = np.zeros(len(todo), np.int64)
    while len(todo):
        x = words[np.minimum(i + k, n)] ^ words[np.minimum(j + k, n)]
        room = n - np.maximum(i, j) - k
        full = (x == 0) & (room > 8)
        part = ~full
        if part.any():
            low = x[part] & (~x[part] + np.uint64(1))
            same = np.where(x[part] == 0, 8, np.floor(np.log2(np.maximum(low, np.uint64(1)).astype(np.float64))).astype(np.int64) // 8)
            size[todo[part]] = k[part] + np.minimum(same, room[part])
        todo, i, j, k = todo[full], i[full], j[full], k[full] + 8
    at = np.maximum.accumulate(np.where(~reducible, pos, 0))
    of = np.zeros(n, np.int64)
    of[heads] = size
    return before, of[at] - (pos - at)


def repeated_starts(pieces: list[bytes], length: int) -> np.ndarray:
    """For the pieces joined with one separator between, True where a string of ``length`` bytes inside a piece starts that
    also starts elsewhere."""
    joined = np.frombuffer(bytes([SEPARATOR]).join(pieces), np.uint8)
    out = np.zeros(len(joined), bool)
    if len(joined) > length:
        before, common = permuted_lcp(joined, suffix_array(joined))
        hit = np.flatnonzero(common >= length)
        out[hit] = True
        out[before[hit]] = True
    end = np.cumsum([len(p) + 1 for p in pieces]) - 1
    room = np.repeat(end, [len(p) + 1 for p in pieces])[: len(joined)] - np.arange(len(joined))
    return out & (room >= length)


# --- anchors


_BYTE = np.random.Generator(np.random.PCG64(20240501)).integers(0, 1 << 64, 256, np.uint64)


def _gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k-gram; k a power of two."""
    h = _BYTE[b]
    step = 1
    while step < k:
        h = h[: len(h) - step] * np.uint64(0x9E3779B97F4A7C15) + h[step:]
        h ^= h >> np.uint64(29)
        step *= 2
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    size, m = 1, v
    while 2 * size <= w:
        m = np.minimum(m[: len(m) - size], m[size:])
        size *= 2
    return np.minimum(m[: len(v) - w + 1], m[w - size : w - size + len(v) - w + 1])


def anchors(texts: list[bytes], length: int, k: int) -> tuple[np.ndarray, ...]:
    """(text, start, windows, hash, offset of the anchor in the core) of each core."""
    joined = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    if len(joined) < length:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    starts = np.cumsum(sizes) - sizes
    grams = _gram_hashes(joined, k)
    # the upper half of the hash, then the place: of grams alike in it the leftmost is picked, in every batch
    low = np.uint64(0xFFFFFFFF)
    picked = (_sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - k + 1) & low).astype(np.int64)
    of = np.repeat(np.arange(len(texts)), sizes)[: len(picked)]
    valid = np.flatnonzero(np.arange(len(picked)) + length <= (starts + sizes)[of])
    if not len(valid):
        return tuple(np.empty(0, np.int64) for _ in range(5))
    p, doc = picked[valid], of[valid]
    new = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1]) | (doc[1:] != doc[:-1]))))
    a = valid[new]
    count = np.diff(np.append(new, len(valid)))
    return doc[new], a - starts[doc[new]], count, grams[p[new]].view(np.int64), p[new] - a


def _cores(docs: DataFrame, length: int) -> DataFrame:
    """r1, r2, at, n, f, c, g of every core: its row, first start, number of windows, anchor's hash and own hash (128 bits in two)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            doc, at, n, f, offset = anchors(texts, length, GRAM)
            own = b"".join(xxhash.xxh3_128_digest(texts[d][x : x + m + length - 1], seed=o) for d, x, m, o in zip(doc.tolist(), at.tolist(), n.tolist(), offset.tolist()))
            cg = np.frombuffer(own, np.int64).reshape(-1, 2)
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(at, pa.int32()), pa.array(n, pa.int32()), pa.array(f), pa.array(cg[:, 0]), pa.array(cg[:, 1])], ["r1", "r2", "at", "n", "f", "c", "g"])

    return docs.select("r1", "r2", "text").mapInArrow(run, "r1 long, r2 long, at int, n int, f long, c long, g long")


RANGES = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
UNIT = ("uf", "uc", "ug")


def _ranges(starts: np.ndarray) -> list[dict[str, int]]:
    """Runs of starts that follow one another."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    return [{"first": a, "last": b} for a, b in zip(starts[np.concatenate(([0], cut + 1))].tolist(), starts[np.concatenate((cut, [len(starts) - 1]))].tolist())]


def _decide(pieces: DataFrame, length: int) -> DataFrame:
    """pieces: uf, uc, ug, piece; a unit has one piece or two. Sorts them by uf and runs a suffix array over about SHARD_BYTES of whole uf's pieces
    at a time. Gives the starts in each unit at which a string begins that another piece, or place, of its shard has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            hit = repeated_starts([r[3] for r in held], length)
            out, at, last = [], 0, None
            for *unit, text in held:
                starts = np.flatnonzero(hit[at : at + len(text)])
                at += len(text) + 1
                if len(starts) and unit != last:
                    out.append((*unit, _ranges(starts)))
                last = unit
            cols = list(zip(*out)) if out else [()] * 4
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], RANGES)], [*UNIT, "ranges"])

        for b in batches:
            for row in zip(*(col.to_pylist() for col in b.columns)):
                if size >= SHARD_BYTES and held[-1][0] != row[0]:
                    yield flush()
                    held, size = [], 0
                if len(held) > 1 and held[-1][:3] == row[:3] == held[-2][:3]:
                    continue  # a row that repeats more than twice
                held.append(row)
                size += len(row[3])
        if held:
            yield flush()

    return pieces.select(*UNIT, "piece").repartition("uf").sortWithinPartitions(*UNIT).mapInArrow(run, "uf long, uc long, ug long, ranges array<struct<first: int, last: int>>")


def _by_window(pieces: DataFrame, length: int) -> DataFrame:
    """As _decide, for anchors of more pieces than a shard takes; pieces: also twice, whether the unit has copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(4).to_pylist()
            n = np.array([len(t) - length + 1 for t in texts], np.int64)
            rows = pa.array(np.repeat(np.arange(len(texts)), n))
            start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(t[i : i + length]) for t in texts for i in range(len(t) - length + 1)), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(rows) for i in range(4)), pa.array(start, pa.int32()), pa.array(h[:, 0]), pa.array(h[:, 1])], [*UNIT, "twice", "s", "h1", "h2"])

    windows = stored(pieces.select(*UNIT, "twice", "piece").mapInArrow(run, "uf long, uc long, ug long, twice boolean, s int, h1 long, h2 long"))
    place = F.struct(*UNIT, "s")
    recur = windows.groupBy("h1", "h2").agg(F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("n"), F.min(place).alias("a"), F.max(place).alias("z")).where("n > 1")
    places = recur.select("h1", "h2", F.explode(F.array("a", "z")).alias("x")).select("h1", "h2", "x.*")
    texts = places.join(pieces.select(*UNIT, "piece"), list(UNIT)).select(F.col("h1").alias("uf"), F.col("h2").alias("uc"), F.lit(0).cast("long").alias("ug"), F.substring("piece", F.col("s") + 1, F.lit(length)).alias("piece"))
    found = _decide(texts, length).select(F.col("uf").alias("h1"), F.col("uc").alias("h2"))
    return windows.join(found, ["h1", "h2"]).groupBy(*UNIT).agg(F.collect_list(F.struct(F.col("s").alias("first"), F.col("s").alias("last"))).alias("ranges"))


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key, text (bytes), and r1 and r2, which tell rows apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).alias("key"), *row_hash(F.col(id_col), text), text.cast("binary").alias("text"))


def _units(cores: DataFrame, length: int) -> DataFrame:
    """cores: f, c, g, n, copies, a, z (first and last place: r1, r2, at). Adds the unit that each core is decided in, the core's offset in it, and, on the
    unit's first core, its number of windows, and whether it must be dealt out by window."""
    twice = F.col("copies") > 1
    size = (F.col("n") + (length - 1)) * F.when(twice, 2).otherwise(1)
    kinds = cores.groupBy("f").agg(F.count("*").alias("kinds"), F.sum(size).alias("bytes"))
    cores = cores.join(kinds, "f").withColumn("twice", twice)
    self = [F.col(k).alias(u) for k, u in zip("fcg", UNIT)]
    beside = cores.where("kinds > 1").select("f", "c", "g", "n", "twice", "a", "z", *self, F.lit(0).alias("off"), F.col("n").cast("long").alias("windows"), (F.col("bytes") > SHARD_BYTES).alias("split"))
    pair = Window.partitionBy("a.r1", "a.r2", "z.r1", "z.r2")
    along = pair.orderBy("a.at")
    goes_on = (F.lag(F.col("a.at") + F.col("n")).over(along) == F.col("a.at")) & (F.lag(F.col("z.at") + F.col("n")).over(along) == F.col("z.at"))
    goes_on &= F.lag(F.floor(F.col("a.at") / RUN_BYTES)).over(along) == F.floor(F.col("a.at") / RUN_BYTES)
    alone = cores.where("kinds = 1").withColumn("new", ~F.coalesce(goes_on, F.lit(False)))
    head = F.last(F.when(F.col("new"), F.struct(F.col("a.at").alias("start"), *self)), ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    alone = alone.withColumn("head", head)
    windows = F.sum("n").over(Window.partitionBy("a.r1", "a.r2", "z.r1", "z.r2", "head"))
    runs = alone.select("f", "c", "g", "n", "twice", "a", "z", *(F.col(f"head.{u}") for u in UNIT), (F.col("a.at") - F.col("head.start")).alias("off"), windows.alias("windows"), F.lit(False).alias("split"))
    return beside.unionAll(runs)


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs: r1, r2, text (bytes). Gives r1, r2, spans array<struct<start, stop>> (may overlap) of rows with repeated strings."""
    spark = docs.sparkSession
    bounded_batches(spark)
    long = docs.where(F.octet_length("text") >= length).select("r1", "r2", "text")
    scratch = shared_dir(spark)
    all_cores = stored(_cores(long, length), scratch)
    recurring = stored(all_cores.groupBy("f").agg(F.count("*").alias("cores")).where("cores > 1"))
    total = recurring.agg(F.sum("cores").alias("n")).first()["n"] or 0
    hot = F.col("cores") > max(HOT_LEAST, total // HOT_SHARE)
    few = F.broadcast(recurring.where(hot).select("f"))  # at most HOT_SHARE anchors; others meet by a shuffle, in which none has more than that share
    shared = stored(all_cores.join(few, "f").unionByName(all_cores.join(few, "f", "left_anti").join(recurring.where(~hot).select("f"), "f")))
    removed(spark, scratch)
    place = F.struct("r1", "r2", "at")
    cores = stored(shared.groupBy("f", "c", "g").agg(F.first("n").alias("n"), F.count("*").alias("copies"), F.min(place).alias("a"), F.max(place).alias("z")))
    units = stored(_units(cores, length))
    cut = lambda p: F.struct(F.col(f"{p}.r1").alias("r1"), F.col(f"{p}.r2").alias("r2"), F.col(f"{p}.at").alias("at"))
    both = F.when(F.col("twice") & ~F.col("split"), F.array(cut("a"), cut("z"))).otherwise(F.array(cut("a")))
    cuts = units.where("off = 0").select(*UNIT, "twice", "split", (F.col("windows") + (length - 1)).cast("int").alias("size"), F.explode(both).alias("p"))
    wanted = cuts.groupBy("p.r1", "p.r2").agg(F.collect_list(F.struct(*UNIT, "twice", "split", "size", "p.at")).alias("cuts"))
    pieces = stored(long.join(wanted, ["r1", "r2"]).select("text", F.explode("cuts").alias("x")).select(*(f"x.{c}" for c in (*UNIT, "twice", "split")), F.substring("text", F.col("x.at") + 1, F.col("x.size")).alias("piece")))
    found = _decide(pieces.where("NOT split"), length)
    if pieces.where("split").head(1):
        found = found.unionAll(_by_window(pieces.where("split"), length))
    # a core's part of its unit's starts
    clipped = F.filter(
        F.transform("ranges", lambda x: F.struct(F.greatest(x["first"] - F.col("off"), F.lit(0)).alias("first"), F.least(x["last"] - F.col("off"), F.col("n") - 1).alias("last"))), lambda x: x["first"] <= x["last"]
    )
    hits = units.join(found, list(UNIT)).select("f", "c", "g", clipped.alias("ranges")).where(F.size("ranges") > 0)
    spans = shared.join(hits, ["f", "c", "g"]).select("r1", "r2", "at", F.explode("ranges").alias("x"))
    return spans.groupBy("r1", "r2").agg(F.collect_list(F.struct((F.col("at") + F.col("x.first")).alias("start"), (F.col("at") + F.col("x.last") + length).alias("stop"))).alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs."""
    out: list[tuple[int, int]] = []
    for x in sorted((s["start"], s["stop"]) for s in spans or ()):
        if out and x[0] <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], x[1])
        else:
            out.append(x)
    return out


def without(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in runs:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def dedup_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    docs = _rows(df, id_col, text_col)
    both = docs.join(repeated_spans(docs, length), ["r1", "r2"], "left").select("key", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for raw, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                runs = merged(found)
                kept = without(raw, runs)
                rows.append((len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = both.schema["key"].dataType.simpleString()
    return both.mapInArrow(run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumnRenamed("id", id_col)


def _kept_text(text: str | None, found: list[dict] | None) -> str | None:
    """Without repeated bytes; a character stays whole if only some of its bytes are repeated."""
    if not found or text is None:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    runs = []
    for a, b in merged(found):
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        runs.append((a, b))
    return without(raw, runs).decode("utf-8", "surrogatepass")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """The same rows with repeated strings taken out of the text."""
    r1, r2, spans = free_names(df, "r1", "r2", "spans")
    found = repeated_spans(_rows(df, id_col, text_col), length).toDF(r1, r2, spans)
    h1, h2 = row_hash(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    both = df.select("*", h1.alias(r1), h2.alias(r2)).join(found, [r1, r2], "left")
    return with_column(both, text_col, "string", pa.string(), (text_col, spans), lambda texts, found: list(map(_kept_text, texts, found))).select(*df.columns)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_digests(table(spark, sf_dir, "documents"))


ORACLE_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
w AS (SELECT doc_id, i, md5(b[i + 1:i + 200]) AS k FROM d, unnest(range(0, n - 199)) t(i)),
c AS (SELECT doc_id, i FROM w QUALIFY count(*) OVER (PARTITION BY k) > 1),
f AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS fresh FROM c),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM f),
s AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS z FROM g GROUP BY doc_id, run),
p AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
k AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS removed, max(z) AS last, string_agg(hex(b[before + 1:a]), '' ORDER BY a) AS head FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       CASE WHEN removed IS NULL THEN sha256(b) ELSE sha256(unhex(head || hex(b[last + 1:n]))) END AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
