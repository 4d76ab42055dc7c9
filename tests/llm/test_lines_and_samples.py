"""Line dedup, importance resampling and hard negatives against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talkweave.llm import hard_negatives, line_dedup, resample, vectors

LONG = "a line of text that has more than forty characters in it"
SPACE = " \t\n\x0b\x0c\r"


def ascii_lower(s):
    return re.sub("[A-Z]", lambda m: m.group().lower(), s)


def brute_lines(rows, min_chars=40, min_docs=5):
    key = lambda line: ascii_lower(line.strip(SPACE))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    shared = {k for k, ids in holders.items() if len(k) >= min_chars and len(ids) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        best = lambda k: max((x for x in holders[k] if x is not None), default=None)
        kept = [x for x in lines if key(x) not in shared or i == best(key(x))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.fixture(scope="module")
def line_texts():
    rng = random.Random(8)
    odd = [LONG, LONG.upper(), f"\t {LONG} \r", f"\x0b{LONG}\x0c", LONG + "É", LONG + "é", LONG[:40], LONG[:39], "é" * 40, "é" * 39, "", "short", " " + LONG, "日本" * 20]
    texts = [None, "", "\n", "\n\n", LONG, "x" * 200_000 + "\n" + LONG, "\n".join(f"{LONG} {k}" for k in range(3000))]
    return texts + ["\n".join(rng.choices(odd, k=rng.randint(1, 8))) for _ in range(60)]


@pytest.mark.parametrize("hot", [10_000, 3])
def test_lines(spark, line_texts, hot, monkeypatch):
    """With a null id, ids that repeat with the same and with another text, and clashing columns; hot lines in both ways."""
    monkeypatch.setattr(line_dedup, "HOT_LEAST", hot)
    rows = list(enumerate(line_texts)) + [(4, LONG), (5, "other\n" + LONG), (None, LONG + "\nof nobody"), (None, LONG[:40])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"h1": F.lit(1), "r1": F.lit("r"), "__lines": F.lit("l"), "id": F.lit(3), "pos": F.lit(4)})
    out = line_dedup.dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    got = out.collect()
    same([(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got], brute_lines(rows))
    assert {(r["h1"], r["r1"], r["__lines"], r["id"], r["pos"]) for r in got} == {(1, "r", "l", 3, 4)}
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_lines_take_other_names_and_limits(spark):
    rows = [(k, "abc\nown " + str(k)) for k in range(3)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "k long, body string"), "k", "body", min_chars=3, min_docs=3, n_lines="before", n_dropped="lost")
    same([tuple(r) for r in out.select("k", "body", "before", "lost").collect()], [(0, "own 0", 2, 1), (1, "own 1", 2, 1), (2, "abc\nown 2", 2, 0)])


# --- importance resampling


def brute_features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))
    return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute_sample(docs, target, percent=5, min_words=20):
    found = [brute_features(t) for _, t in docs]
    s, t = Counter(b for _, f in found for b in f), Counter(b for x in target for b in brute_features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)}
    rows = []
    for (i, _), (n, f) in zip(docs, found):
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    may = sorted((r for r in rows if r[5] >= min_words and r[0] is not None), key=lambda r: (-r[3], r[0], r[1]))
    for k, r in enumerate(may[: percent * len(may) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


@pytest.mark.parametrize("piece", [2 << 20, 5, 64])
def test_features(piece, monkeypatch):
    """CRCs of runs over the borders of pieces, words longer than the tables, null texts and other scripts."""
    monkeypatch.setattr(resample, "PIECE", piece)
    rng = random.Random(piece)
    for _ in range(40):
        texts = [None if rng.random() < 0.1 else "".join(rng.choices(["a", "B", "é", "ß ", "word", "x" * 60, "y" * 300, "İ", " ", "\n", "-", "9", "'", "\x00", "日本"], k=rng.randint(0, 50))) for _ in range(rng.randint(0, 8))]
        words, found = [0] * len(texts), [[] for _ in texts]
        for k, (row, bucket) in enumerate(resample.features(pa.array(texts, pa.string()))):
            for i, b in zip(row.tolist(), bucket.tolist()):
                found[i].append(b)
                words[i] += k % resample.RUN == 0
        assert [(n, sorted(f)) for n, f in zip(words, found)] == [(n, sorted(f)) for n, f in map(brute_features, texts)]


@pytest.fixture(scope="module")
def sample_docs():
    rng = random.Random(4)
    words = "alpha Beta gamma delta été ÉTÉ x9 1 2 über".split()
    texts = [None, "", " .,- ", "one two three", "long " * 60_000] + [" ".join(rng.choices(words, k=rng.choice((19, 20, 21, 60)))) for _ in range(300)]
    return list(enumerate(texts)), [None, "", "gamma delta x9", "über über alpha"]


@pytest.mark.parametrize("percent", [5, 37, 100])
def test_resample(spark, sample_docs, percent, monkeypatch):
    monkeypatch.setattr(resample, "WAYS", 3)
    docs, target = sample_docs
    df = spark.createDataFrame([*docs, (None, docs[9][1])], "doc_id long, text string").withColumns({"bucket": F.lit("b"), "score": F.lit("s"), "rank": F.lit(0)}).repartition(5)
    out = resample.importance_resample(df, spark.createDataFrame([(t,) for t in target], "text string"), percent=percent)
    same([tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect()], brute_sample([*docs, (None, docs[9][1])], target, percent))


def test_resample_repeated_rows(spark):
    """Rows alike in score and id are drawn as often as they fit; ranks have no gap."""
    docs = [(7, "word " * 25)] * 60 + [(k, "word " * 25) for k in range(20)]
    out = resample.importance_resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("word",)], "text string"), percent=50).collect()
    drawn = sorted((r["rank"], r["doc_id"], r["score"]) for r in out if r["rank"] is not None)
    assert [r for r, _, _ in drawn] == list(range(1, 41)) and len(out) == 80
    want = sorted(brute_sample(docs, ["word"], 50), key=lambda r: (-r[3], r[0]))[:40]
    assert [(i, s) for _, i, s in drawn] == [(r[0], r[3]) for r in want]


def test_resample_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "word " * 30)], "doc_id long, text string")
    assert resample.importance_resample(none, some.select("text")).count() == 0
    assert [tuple(r)[4:] for r in resample.importance_resample(some, none.select("text")).select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()][0][1] is None


@pytest.mark.parametrize("n", [1, 2, 5, 9, 10])
def test_cutoff(spark, n):
    values = [-(10**15), -3, -3, 0, 0, 0, 5, 5, 10**15, 10**15]
    assert resample.cutoff(spark.createDataFrame([(v,) for v in values], "v long"), "v", n) == sorted(values)[n - 1]


# --- hard negatives


def brute_negatives(rows):
    good = [(i, c, np.floor(256 * np.array(v)).astype(int)) for i, v, c in rows if i is not None and c is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, c, v in good:
        if i % 100:
            continue
        scores = [(int(v @ w), j, d) for j, d, w in good if len(w) == len(v)]
        for ps, p, _ in sorted((r for r in scores if r[2] == c and r[1] != i), key=lambda r: (-r[0], r[1]))[:5]:
            hard = sorted((r for r in scores if r[2] != c and 80 * ps <= 100 * r[0] <= 100 * ps), key=lambda r: (-r[0], r[1]))[:5]
            out += [(i, p, k + 1, j, ps, s) for k, (s, j, _) in enumerate(hard)]
    return out


@pytest.mark.parametrize("block,focus,slots", [(8192, 4, None), (16, 1, None), (16, 8, 200)])
def test_hard_negatives(spark, block, focus, slots, monkeypatch):
    """Clustered vectors of very different lengths, zero and missing ones, ties and other dimensions, in one and in many cells."""
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "FOCUS", focus)
    if slots:
        monkeypatch.setattr(vectors, "QUERY_BYTES", slots)
        monkeypatch.setattr(vectors, "CHUNK_BYTES", 20 * slots)
        monkeypatch.setattr(vectors, "MOST_PARTITIONS", 3)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(500):
        c = int(rng.integers(6))
        rows.append((i, [float(x) for x in ((centres[c] + rng.normal(size=8) * 0.4) * rng.choice((0.05, 1, 3))).round(2)], c if rng.random() < 0.8 else int(rng.integers(6))))
    rows[100] = (100, rows[200][1], rows[200][2])
    rows[7], rows[8] = (7, [0.0] * 8, 1), (8, rows[9][1], rows[9][2])
    rows += [(600, None, 1), (700, [1.0, None] * 4, 1), (800, [1.0] * 8, None), (900, [float("nan")] * 8, 2), (None, [1.0] * 8, 2), (1000, [1.0, 2.0], 1), (1001, [1.0, 2.5], 1), (1002, [1.0, 2.0], 2), (1100, [], 1), (1200, [0.0] * 8, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"id": F.lit("x"), "key": F.lit(1), "group": F.lit(2)}).repartition(3)
    out = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()
    want = brute_negatives(rows)
    assert len(want) > 30
    same([tuple(r) for r in out], want)
    assert hard_negatives.hard_negatives(df.limit(0), F.lit(True)).count() == 0


def test_coordinate_pruning_loses_nothing():
    """Every row that reaches the threshold is a candidate, and many others are not."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2000, 6)) * rng.uniform(0.5, 1, size=(2000, 1))
    bucket = hard_negatives.LengthBucket(np.arange(2000), np.zeros(2000, np.int64), x)
    spared = 0
    for q in [*rng.normal(size=(30, 6)), np.eye(6)[0], -np.eye(6)[2], np.ones(6)]:
        norm = float(np.sqrt(q @ q))
        for share in (0.3, 0.7, 0.95, 1.0):
            least = float(np.quantile(x @ q, 0.5) * (1 - share) + (x @ q).max() * share)
            rows = bucket.candidates(q / norm, norm, least)
            full = set(np.flatnonzero(x @ q >= least))
            assert rows is None or full <= set(rows)
            spared += 0 if rows is None else 2000 - len(rows)
    assert spared > 0.4 * 33 * 4 * 2000


def test_small_tables_have_sql(tmp_path, spark):
    """The SQL on null, odd and repeated input."""
    vec = spark.createDataFrame([(0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.9, 0.5], 2), (3, None, 1), (4, [1.0, float("inf")], 2), (7, [0.95, 0.5], 1), (8, [0.9, 0.5], None)], "vec_id long, embedding array<float>, label int")
    docs = spark.createDataFrame([(k, f"{LONG}\nown {k}\n{LONG}" if k else None) for k in range(8)], "doc_id long, text string")
    vec.coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    for t in ("embeddings", "documents"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    for f, sql in ((hard_negatives.op12_hard_negatives, hard_negatives.ORACLE_SQL), (line_dedup.op13_line_dedup, line_dedup.ORACLE_SQL)):
        got = f(spark, str(tmp_path)).toPandas()
        want = c.execute(sql).df()
        assert len(want) and list(got.columns) == list(want.columns)
        same(got.itertuples(index=False, name=None), want.itertuples(index=False, name=None))
