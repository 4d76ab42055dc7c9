"""Importance resampling towards a target distribution, on hashed word runs.

Features are the runs of one to three consecutive words, each in the bucket of its CRC-32. Two passes of counting give, by bucket, how often the corpus and the target
have it; the ratio's logarithm is the bucket's gain. These gains are an array of ``BUCKETS`` numbers, sent to all tasks, in which every document's
features are looked up and summed to its weight. A Gumbel draw that depends on seed and id only is added, so that the highest scores are a sample
without replacement by weight.

The highest scores are found without sorting all documents: scores are written once, and exact counts over them narrow the cutoff down, several bisections a
job; equal scores at the cutoff are narrowed down by doc_id in the same way. Only rows above the cutoff are then range-partitioned and numbered.

CRCs are computed with arrays: those of words byte by byte for all words of a piece at once, those of runs from the words' by the rule for a CRC of
concatenated strings. Texts are read in pieces that end between words, with two words carried over, so memory doesn't grow with a text.

Results for edge cases: a null, empty or wordless text has no features, weight 0, and is never drawn. A row without an id (null) has a weight, but no score, and is
never drawn. Equal scores go to the smaller id, then to fewer features; rows that are alike in all three are drawn as often as they fit. An empty table gives
an empty one; an empty target leaves S and s alone in the gains. Other columns, whatever their names, are ignored. Texts are read whole, however long.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm.common import bounded_batches, stored, table
from talkweave.operators.ordinal import ordinal

BUCKETS = 10_000
RUN = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
#: Bytes of text that are looked at at once.
PIECE = 2 << 20
#: Counts that one job takes: each narrows the cutoff down to a part in so many.
WAYS = 32
#: Words up to so many bytes have tables of their own.
SHORT = 48

_BYTE = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
_IN_WORD = ((_BYTE >= 48) & (_BYTE <= 57)) | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)


def _crc_step() -> np.ndarray:
    """What a byte does to the register of the CRC-32 of zlib."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_STEP = _crc_step()


def _over(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by four tables of a byte each, applied to c."""
    return table[0][c & 255] ^ table[1][(c >> 8) & 255] ^ table[2][(c >> 16) & 255] ^ table[3][c >> 24]


def _zero_bytes(n: int, of: np.ndarray | None = None) -> np.ndarray:
    """The map that n further zero bytes are to a CRC (to ``of``, by default from the identity)."""
    t = np.stack([_BYTE.astype(np.uint32) << (8 * k) for k in range(4)]) if of is None else of
    for _ in range(n):
        t = _STEP[t & 255] ^ (t >> 8)
    return t


#: _SHIFT[n]: n zero bytes, flat tables by length; _DOUBLE[k]: 2^k zero bytes.
_SHIFT = np.stack([_zero_bytes(n) for n in range(SHORT + 1)])
_DOUBLE = [_zero_bytes(1)]
for _ in range(39):
    _DOUBLE.append(_over(_DOUBLE[-1], _DOUBLE[-1]))


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC's part in that of a string with so many bytes more."""
    n = np.minimum(lengths, SHORT)
    out = _SHIFT[n, 0, crc & 255] ^ _SHIFT[n, 1, (crc >> 8) & 255] ^ _SHIFT[n, 2, (crc >> 16) & 255] ^ _SHIFT[n, 3, crc >> 24]
    far = np.flatnonzero(lengths > SHORT)
    if len(far):
        c, rest = out[far], lengths[far] - SHORT
        for k in range(int(rest.max()).bit_length()):
            c = np.where((rest >> k) & 1 == 1, _over(_DOUBLE[k], c), c)
        out[far] = c
    return out


def word_crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of each word of ``data``."""
    out = np.empty(len(starts), np.uint32)
    short = np.flatnonzero(lengths <= SHORT)
    short = short[np.argsort(-lengths[short], kind="stable")]
    at, n = starts[short], lengths[short]
    crc = np.full(len(short), 0xFFFFFFFF, np.uint32)
    left = len(short)
    for k in range(int(n[0]) if left else 0):
        left = int(np.searchsorted(-n, -k, side="left"))  # words longer than k come first
        c = crc[:left]
        crc[:left] = _STEP[(c ^ data[at[:left] + k]) & 255] ^ (c >> 8)
    out[short] = ~crc
    for i in np.flatnonzero(lengths > SHORT):
        out[i] = zlib.crc32(data[starts[i] : starts[i] + lengths[i]])
    return out


def pieces(text: np.ndarray) -> Iterator[np.ndarray]:
    """The bytes of a text in lower case, cut between words."""
    at = 0
    while at < len(text):
        to = at + PIECE
        part = _LOWER[text[at:to]]
        while to < len(text) and _IN_WORD[part[-1]]:
            gaps = np.flatnonzero(~_IN_WORD[part])
            if len(gaps):
                part = part[: gaps[-1] + 1]
                break
            part = np.concatenate((part, _LOWER[text[to : to + PIECE]]))
            to += PIECE
        yield part
        at += len(part)


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(row, bucket, words) of the features of all texts; row and bucket are arrays, words are those newly met in the rows of the arrays: a run belongs
    to its last word, so rows of one word each are given once for each length of run."""
    texts = texts.cast(pa.large_string()) if pa.types.is_string(texts.type) else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    null = texts.is_null().to_numpy(zero_copy_only=False)
    waiting: list[tuple[int, np.ndarray]] = []
    size = 0
    carry = (np.empty(0, np.int64), np.empty(0, np.uint32), np.empty(0, np.int64))

    def runs():
        nonlocal carry, waiting, size
        # texts are parted by a byte that no word has
        joined = np.concatenate([x for _, part in waiting for x in (part, np.zeros(1, np.uint8))])
        mask = np.concatenate(([False], _IN_WORD[joined], [False]))
        edges = np.flatnonzero(mask[1:] != mask[:-1])
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        ends = np.cumsum([len(part) + 1 for _, part in waiting])
        row = np.array([r for r, _ in waiting])[np.searchsorted(ends, starts, side="right")]
        crc = word_crcs(joined, starts, lengths)
        old = len(carry[0])
        row, crc, lengths = (np.concatenate(x) for x in zip(carry, (row, crc, lengths)))
        run, first = crc, np.arange(old, len(row))
        yield row[first], run[first] % BUCKETS
        gap = np.uint32(zlib.crc32(b" "))
        for back in range(1, RUN):
            # run[i] is the run of ``back`` words that ends at i; longer by the word before it: CRC(word + " ") moved by the run's length
            span = lengths.copy()
            for k in range(1, back):
                span[k:] += lengths[:-k] + 1
            longer = np.zeros(len(crc), np.uint32)
            before = shifted(crc, np.ones(len(crc), np.int64)) ^ gap
            longer[back:] = shifted(before[:-back], span[back:]) ^ run[back:]
            run = longer
            first = np.arange(max(old, back), len(row))
            first = first[row[first] == row[first - back]]
            yield row[first], run[first] % BUCKETS
        carry = (row[1 - RUN :], crc[1 - RUN :], lengths[1 - RUN :])
        waiting, size = [], 0

    for i in np.flatnonzero(~null):
        for part in pieces(data[offsets[i] : offsets[i + 1]]):
            waiting.append((int(i), part))
            size += len(part)
            if size >= PIECE:
                yield from runs()
    if waiting:
        yield from runs()


def bucket_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """bucket, n: how many features of all texts fall into each; tasks send one row a bucket."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, bucket in features(b.column(0)):
                total += np.bincount(bucket, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(total[some])], ["bucket", "n"])

    return df.select(text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of each bucket from counts of both (bucket, n): an array of BUCKETS numbers."""
    counts = []
    for df in (corpus, target):
        c = np.zeros(BUCKETS)
        for r in df.collect():  # one row a bucket
            c[r["bucket"]] = r["n"]
        counts.append(c)
    s, t = counts
    all_s, all_t = float(s.sum()), float(t.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (all_s + BUCKETS) / ((a + 1) * (all_t + BUCKETS)))) for a, b in zip(s.tolist(), t.tolist())], np.int64)


def gumbel(doc_id: int, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of each row."""
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast(gains(bucket_counts(df, text_col), bucket_counts(target, target_text)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for b in batches:
            n = b.num_rows
            found, words, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for k, (row, bucket) in enumerate(features(b.column(1))):
                here = np.bincount(row, minlength=n)
                found += here
                if k % RUN == 0:
                    words += here
                weight += np.bincount(row, gain[bucket], n).astype(np.int64)  # whole numbers, exact as floats
            ids = b.column(0).to_pylist()
            score = [None if i is None else int(w) + gumbel(i, seed) for i, w in zip(ids, weight)]
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, (words, found, weight)), pa.array(score, pa.int64())], ["doc_id", "n_words", "n_features", "weight", "score"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def cutoff(values: DataFrame, col: str, n: int) -> int | None:
    """The n-th smallest value of a whole-number column, by exact counts over ever narrower ranges; None where there are fewer. A job counts at WAYS - 1 thresholds."""
    edge = values.agg(F.min(col).alias("low"), F.max(col).alias("high"), F.count(col).alias("n")).first()
    if n < 1 or n > edge["n"]:
        return None
    low, high = int(edge["low"]), int(edge["high"])  # the n-th is in [low, high]
    while low < high:
        width = -(-(high - low + 1) // WAYS)
        at = [a for a in range(low + width - 1, high, width)]
        seen = values.agg(*(F.count_if(F.col(col) <= F.lit(a)).alias(f"c{k}") for k, a in enumerate(at))).first()
        for k, a in enumerate(at):
            if seen[k] >= n:
                high = a
                break
            low = a + 1
    return low


def ranked(scores: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """scores (stored) with rank: 1, 2, 3... by score downwards and id, null where a row isn't drawn."""
    may = (F.col("n_words") >= min_words) & F.col("doc_id").isNotNull()
    some = scores.where(may).select(F.negate("score").alias("down"), "doc_id")
    n = percent * some.count() // 100
    down = cutoff(some, "down", n)
    if down is None:
        return scores.withColumn("rank", F.lit(None).cast("long"))
    tied = some.where(F.col("down") == down)
    last = cutoff(tied, "doc_id", n - some.where(F.col("down") < down).count())
    above = may & ((F.col("score") > -down) | ((F.col("score") == -down) & (F.col("doc_id") <= last)))
    drawn = ordinal(scores.where(above).withColumn("down", F.negate("score")), "down", "doc_id", "n_features", name="rank").drop("down")
    rank = F.col("rank") + 1
    # rows alike in score and id may go beyond the number wanted
    return drawn.withColumn("rank", F.when(rank <= n, rank).cast("long")).unionByName(scores.where(~F.coalesce(above, F.lit(False))).withColumn("rank", F.lit(None).cast("long")))


def importance_resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of each row of df; those with a rank are the sample."""
    return ranked(stored(scored(df, target, id_col, text_col, target_text, seed)), percent, min_words)


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
