"""Near-duplicate groups by a chosen-path set similarity join.

A document is the set of its word shingles; equal sets become one node at once, so groups of copies cost one node however
large. A node has a sketch of minwise tokens. In each of ``trees`` independent trees, nodes are branched recursively: at
a path, one coordinate of the sketch is chosen, and sometimes a second, so that 1 / similarity are expected;
the token there extends the path. Two nodes of the wanted similarity so share one path on average at any depth, and
unlike ones hardly any. Paths depend on a node's sketch only, so all trees go down several levels in one pass.

Nodes that meet at a path are compared: first with one member of the path's group, the hub, and the likeliest such link
of each is confirmed on full sets. That already joins large groups of near copies, by a link per member. Then groups whose
members are not yet all connected are compared exhaustively where they are small: likely pairs between components
are kept for confirmation; groups of up to LARGE in pairs of blocks on full sets, leaving out blocks of one component, which a task each does without rows for its pairs. Groups of more than LARGE are branched further, as long as that splits
them into few parts of their size. The nodes of groups of more than LARGE that stay together, as pages of one
template do, go into one index by the prefixes of their sets, rare tokens first: the smaller set of a pair is met by a short prefix, the other by a longer one, which
misses no pair as similar as wanted, and brings pages together only if they share what is rare. So work per node is bounded, and both ways are exact. Only links come out, so no group is ever expanded into all its pairs.

A path may be shared by very many nodes, and a token by very many sets: their rows are dealt over SALTS tasks wherever they meet what is known of the path or token.

Sets hold 64-bit hashes of shingles. Confirmed links make a graph; its components come from repeated
minimum labels with pointer jumping. Recall of a pair at the wanted similarity: about 0.9999 with 12 trees.

Results for edge cases: without words or text (null too) the set is empty, and the document is linked with nothing; fewer
words than a shingle make one shingle. Rows that repeat an id are rows of their own, told apart by a 128-bit hash of id and text; component_id is the
least id of a component's rows (null ids are not compared and have no component of their own). A text of any length is one row of its task. An empty table gives an empty one. Other columns are ignored by near_duplicates(), and kept by
keep_one(), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm.common import bounded_batches, free_names, row_hash, stored, table

COORDINATES = 128
TREES = 12
#: Trees whose hubs are tried first.
HUB_TREES = 4
LEVELS, MORE_LEVELS = 6, 4
#: Independent trees below a very large group, so that branching it further loses hardly any pair.
AGAIN = 3
#: Groups up to SMALL are compared by sketches; up to LARGE in blocks on full sets; larger ones are branched further as long as they split, and what doesn't split goes to the index.
SMALL, LARGE, BLOCK = 32, 8192, 256
#: Bytes of sets in a block, about.
BLOCK_BYTES = 4 << 20
#: A round of branching makes about six rows of one (AGAIN trees, 1 / similarity at each level), so it saves work only where a branch holds less than this share of the group above.
WHOLE = 0.15
#: Buckets in which tokens are counted, to know the rare ones.
RARITY = 1 << 20
#: Tasks over which the rows of one path are dealt.
SALTS = 8
#: How far an estimate from sketches may lie below the wanted similarity, in standard deviations.
SLACK = 4.5

_SEEDS = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 32, (2, COORDINATES), np.uint64).astype(np.uint32)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; words are parted by ASCII white space, with A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    seen: dict[bytes, int] = dict.fromkeys(words, 0)
    for w in seen:
        seen[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    out = np.full(n, np.uint64(min(size, len(h))), np.uint64)
    for k in range(min(size, len(h))):
        out = (out ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return np.unique(out)


def sketch(items: np.ndarray) -> np.ndarray:
    """For each coordinate 16 bits of the least token."""
    x = (items ^ (items >> np.uint64(32))).astype(np.uint32)
    out = np.empty(COORDINATES, np.uint16)
    for c in range(0, COORDINATES, 32):
        h = (x[None, :] ^ _SEEDS[0, c : c + 32, None]) * (_SEEDS[1, c : c + 32, None] | np.uint32(1))
        h ^= h >> np.uint32(15)
        least = (h * np.uint32(0x85EBCA6B)).min(axis=1)
        out[c : c + 32] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def descend(paths: np.ndarray, rows: np.ndarray, sketches: np.ndarray, levels: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Extends (path, row of sketches) by some levels."""
    second = np.uint64(int((1 / similarity - 1) * (1 << 20)))
    for _ in range(levels):
        choice = _mix(paths)
        one = (choice % np.uint64(COORDINATES)).astype(np.int64)
        two = ((choice >> np.uint64(8)) % np.uint64(COORDINATES)).astype(np.int64)
        both = ((choice >> np.uint64(24)) & np.uint64((1 << 20) - 1)) < second
        both &= one != two
        step = lambda at, r, c: _mix(at ^ ((sketches[r, c].astype(np.uint64) << np.uint64(8)) + c.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        paths = np.concatenate((step(paths, rows, one), step(paths[both], rows[both], two[both])))
        rows = np.concatenate((rows, rows[both]))
    return paths, rows


def _sketches(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(-1, COORDINATES)


def set_rows(df: DataFrame, size: int) -> DataFrame:
    """df: key, r1, r2, text. Adds n, node (null for an empty set) and sketch in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, node, sk = [], [], []
            for text in b.column(3).to_pylist():
                items = shingle_set(text, size)
                n.append(len(items))
                node.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
                sk.append(sketch(items).tobytes() if len(items) else None)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(sk, pa.binary())], ["key", "r1", "r2", "n", "node", "sketch"])

    kind = df.schema["key"].dataType.simpleString()
    return df.select("key", "r1", "r2", "text").mapInArrow(run, f"key {kind}, r1 long, r2 long, n long, node binary, sketch binary")


def _spread(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """rows (with node) joined to what is known of each key; the rows of one key are dealt over SALTS tasks."""
    salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.hash("node"), F.lit(SALTS))).join(salted, [key, "salt"]).drop("salt")


def _first_paths(nodes: DataFrame, trees: int, similarity: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sk = _sketches(b.column(1))
            for tree in range(trees):
                start = np.full(len(sk), _mix(np.array([tree + 1], np.uint64))[0])
                paths, rows = descend(start, np.arange(len(sk)), sk, LEVELS, similarity)
                yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), pa.array([tree < HUB_TREES] * len(paths)), b.column(0).take(pa.array(rows))], ["path", "early", "node"])

    return nodes.select("node", "sketch").mapInArrow(run, "path long, early boolean, node binary")


def _more_paths(met: DataFrame, similarity: float) -> DataFrame:
    """met: path, size, node, sketch. Gives up, the size of the group above, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                above, sk = b.column(0).to_numpy().view(np.uint64), _sketches(b.column(3))
                parts = [descend(_mix(above + np.uint64(k)), np.arange(b.num_rows), sk, MORE_LEVELS, similarity) for k in range(AGAIN)]
                paths, rows = map(np.concatenate, zip(*parts))
                yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), b.column(1).take(pa.array(rows)), b.column(2).take(pa.array(rows))], ["path", "up", "node"])

    return met.select("path", "size", "node", "sketch").mapInArrow(run, "path long, up long, node binary")


def _likely(pairs: DataFrame, least: float) -> DataFrame:
    """pairs: a, b, sa, sb; adds the estimate and keeps likely pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                e = (_sketches(b.column(2)) == _sketches(b.column(3))).mean(axis=1)
                keep = pa.array(np.flatnonzero(e >= least))
                yield pa.RecordBatch.from_arrays([b.column(0).take(keep), b.column(1).take(keep), pa.array(e).take(keep)], ["a", "b", "e"])

    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary, e double")


def _crossing(groups: DataFrame, least: float) -> DataFrame:
    """groups: members array<struct<node, comp, sketch>> of small groups; likely pairs between components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for members in batch.column(0).to_pylist():
                sk = np.frombuffer(b"".join(m["sketch"] for m in members), np.uint16).reshape(-1, COORDINATES)
                for i, j in combinations(range(len(members)), 2):
                    if members[i]["comp"] != members[j]["comp"] and (sk[i] == sk[j]).mean() >= least:
                        x, y = sorted((members[i]["node"], members[j]["node"]))
                        a.append(x)
                        b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return groups.select("members").mapInArrow(run, "a binary, b binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs a, b whose full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(k)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64()))], ["a", "b"])

    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
    return left.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def _exact_links(left: list[dict], right: list[dict] | None, percent: int) -> list[tuple[bytes, bytes]]:
    """Links between members of different components, as many as connect them. right None: within left."""
    both = left + (right or [])
    sets = [np.frombuffer(m["items"], np.uint64) for m in both]
    size = np.array([len(x) for x in sets], np.int64)
    flat = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), size)
    values, at, n = np.unique(flat, return_inverse=True, return_counts=True)
    shared = n[at] > 1  # others are in no intersection
    number = np.cumsum(n > 1) - 1
    of, item = of[shared], number[at[shared]]
    k = len(left)
    common = np.zeros((k, len(both) - k if right else k), np.float64)
    order = np.argsort(item, kind="stable")
    of, item = of[order], item[order]
    step = max(1024, (1 << 24) // len(both))
    for low in range(0, int(item[-1]) + 1 if len(item) else 0, step):
        i, j = np.searchsorted(item, [low, low + step])
        m = np.zeros((len(both), step), np.float32)
        m[of[i:j], item[i:j] - low] = 1
        common += m[:k] @ (m[k:] if right else m).T
    a_size, b_size = size[:k], size[k:] if right else size
    linked = 100 * common >= percent * (a_size[:, None] + b_size[None, :] - common)
    root: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while (y := root.get(x, x)) != x:
            root[x] = root.get(y, y)
            x = y
        return x

    out = []
    for i, j in zip(*np.nonzero(linked)):
        a, b = left[i], (right or left)[j]
        x, y = find(a["comp"]), find(b["comp"])
        if x != y:
            root[x] = y
            out.append((a["node"], b["node"]))
    return out


def _block_links(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """groups: path, node, comp, n of larger groups. Members are dealt to blocks of about BLOCK (or BLOCK_BYTES), those of one large component to
    blocks of their own; pairs of blocks are compared on full sets, but for two blocks of one component."""
    weight = F.greatest(F.lit(1 / BLOCK), F.col("n") * 8 / BLOCK_BYTES)  # in blocks
    w = groups.groupBy("path", "comp").agg(F.sum(weight).alias("w"))
    small = F.col("w") < 1
    rest = w.groupBy("path").agg(F.sum(F.when(small, F.col("w"))).alias("rest"))
    dealt = _spread(groups.select("path", "node", "comp").join(w, ["path", "comp"]), rest, "path")
    part = F.pmod(F.xxhash64("node"), F.ceil(F.when(small, F.col("rest")).otherwise(F.col("w"))))
    dealt = stored(dealt.select("path", "node", "comp", F.when(~small, F.col("comp")).alias("own"), part.alias("part")))
    blocks = stored(dealt.join(sets, "node").groupBy("path", "own", "part").agg(F.collect_list(F.struct("node", "comp", "items")).alias("members")).withColumn("block", F.xxhash64("own", "part")))
    ids = blocks.select("path", "block", "own")
    other = ids.select("path", F.col("block").alias("block_b"), F.col("own").alias("own_b"))
    pairs = ids.join(other, "path").where((F.col("block") <= F.col("block_b")) & (F.col("own").isNull() | ~F.col("own").eqNullSafe(F.col("own_b")))).select("path", "block", "block_b")
    met = pairs.join(blocks.select("path", "block", F.col("members").alias("x")), ["path", "block"])
    met = met.join(blocks.select("path", F.col("block").alias("block_b"), F.col("members").alias("y")), ["path", "block_b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x, y = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                links = _exact_links(x, y if not batch.column(0)[i].as_py() else None, percent)
                if links:
                    a, b = zip(*links)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return met.select((F.col("block") == F.col("block_b")).alias("same"), "x", "y").mapInArrow(run, "a binary, b binary")


def _token_counts(sets: DataFrame) -> np.ndarray:
    """How often tokens occur in all sets, by RARITY buckets of their hash: a guide to which are rare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(RARITY, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                np.add.at(total, (np.frombuffer(x, np.uint64) % np.uint64(RARITY)).astype(np.int64), 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "k"])

    found = sets.select("items").mapInArrow(run, "bucket long, k long").groupBy("bucket").agg(F.sum("k").alias("k")).toArrow()
    out = np.zeros(RARITY, np.int64)
    out[found["bucket"].to_numpy()] = found["k"].to_numpy()
    return out


def _prefixes(members: DataFrame, percent: int) -> DataFrame:
    """members: node, comp, n, items. A row for each token of a set's prefix, rare tokens first: token, node, comp, n and whether it is in the short prefix, which is enough for the smaller
    set of a pair: of two sets as similar as wanted the first token in common is in the short prefix of the smaller and in the prefix of the other."""
    sent = members.sparkSession.sparkContext.broadcast(_token_counts(members))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = sent.value
        for b in batches:
            if not b.num_rows:
                continue
            tokens, rows, short = [], [], []
            for k, x in enumerate(b.column(3).to_pylist()):
                x = np.frombuffer(x, np.uint64)
                n = len(x)
                long_ = n + percent * -n // 100 + 1  # n - ceil(percent * n / 100) + 1
                few = n + 2 * percent * -n // (100 + percent) + 1
                first = x[np.lexsort((x, count[(x % np.uint64(RARITY)).astype(np.int64)]))[:long_]]
                tokens.append(first)
                rows.append(np.full(len(first), k))
                short.append(np.arange(len(first)) < few)
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), b.column(0).take(at), b.column(1).take(at), b.column(2).take(at), pa.array(np.concatenate(short))], ["token", "node", "comp", "n", "short"])

    return members.select("node", "comp", "n", "items").mapInArrow(run, "token long, node binary, comp binary, n long, short boolean")


def _index_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of different components that an index of prefixes brings together: every pair as similar as wanted is among them. Tokens of one component only are left out; of others, the
    largest component's rows meet only those of other components, so near copies of one text that are linked already are not met with each other. Rows of a token are dealt over SALTS tasks."""
    rows = stored(_prefixes(members, percent))
    by_comp = rows.groupBy("token", "comp").agg(F.count("*").alias("k"))
    mixed = by_comp.groupBy("token").agg(F.count("*").alias("comps"), F.max_by("comp", F.struct("k", "comp")).alias("big")).where("comps > 1").select("token", "big")
    met = stored(_spread(rows, mixed, "token").withColumn("other", F.col("comp") != F.col("big")).drop("big"))
    salt = F.pmod(F.hash("node"), F.lit(SALTS)).alias("salt")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    name = lambda side: [F.col(c).alias(f"{c}_{side}") for c in ("node", "comp", "n")]

    def joined(small: DataFrame, large: DataFrame) -> DataFrame:
        order = (F.col("n_x") < F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("node_x") < F.col("node_y")))
        close = (F.col("comp_x") != F.col("comp_y")) & order & (100 * F.col("n_x") >= percent * F.col("n_y"))
        return small.join(large, ["token", "salt"]).where(close).select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"))

    # the smaller set by its short prefix; whoever isn't of the largest component is sent to all tasks of the token
    first = joined(met.where("short AND other").select("token", every, *name("x")), met.select("token", salt, *name("y")))
    second = joined(met.where("short AND NOT other").select("token", salt, *name("x")), met.where("other").select("token", every, *name("y")))
    return first.unionAll(second).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and comp (the least node reachable) of every node that has a link."""
    both = stored(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("near"))
        new = labels.join(near, labels["node"] == near["a"]).select("node", "comp", F.least("comp", "near").alias("low"))
        of = labels.select(F.col("node").alias("of"), F.col("comp").alias("its"))
        new = stored(new.join(of, new["low"] == of["of"]).select("node", F.least("low", "its").alias("comp"), (F.least("low", "its") != F.col("comp")).alias("changed")))
        labels = new.select("node", "comp")
        if not new.where("changed").head(1):
            return labels


def linked_sets(docs: DataFrame, size: int, percent: int, trees: int = TREES) -> tuple[DataFrame, DataFrame]:
    """docs: key, r1, r2, text. Gives the rows' sets (key, r1, r2, n, node) and node, comp of the nodes that have links."""
    spark = docs.sparkSession
    bounded_batches(spark)
    similarity = percent / 100
    least = similarity - SLACK * (similarity * (1 - similarity) / COORDINATES) ** 0.5
    rows = stored(set_rows(docs, size))
    nodes = stored(rows.where("n > 0").groupBy("node").agg(F.first("sketch").alias("sketch"), F.first("n").alias("n"), F.min(F.struct("r1", "r2")).alias("place")))
    sk = nodes.select("node", "sketch")
    paths = _first_paths(nodes, trees, similarity)
    groups = paths.groupBy("path").agg(F.count("*").alias("size"), F.min("node").alias("hub")).where("size > 1")
    met = stored(_spread(paths, groups, "path"))

    # full sets of the nodes that met any other
    some = nodes.join(met.select("node").distinct(), "node").select("node", "place.*")

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t, size).tobytes() for t in b.column(1).to_pylist()], pa.binary())], ["node", "items"])

    texts = docs.join(some, ["r1", "r2"]).select("node", "text")
    sets = stored(texts.mapInArrow(items, "node binary, items binary").dropDuplicates(["node"]))

    # the likeliest hub of each node
    hubs = met.where("early AND node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    hubs = hubs.join(sk.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a").join(sk.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b")
    best = _likely(hubs, least).groupBy("a").agg(F.max(F.struct("e", "b")).alias("best")).select("a", "best.b")
    links = stored(_confirmed(best, sets, percent))
    comp = components(links)

    # groups that are not one component yet
    found, direct, rest = [], [], []
    here = met.select("path", F.lit(None).cast("long").alias("up"), "node")
    while True:
        label = here.join(comp, "node", "left").select("path", "up", "node", F.coalesce("comp", "node").alias("comp"))
        mixed = label.groupBy("path").agg(F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("path", "size")
        open_ = stored(_spread(label, mixed, "path").join(nodes.select("node", "n"), "node"))
        whole = open_.where(F.col("size") <= SMALL).join(sk, "node").groupBy("path").agg(F.collect_list(F.struct("node", "comp", "sketch")).alias("members"))
        found.append(_crossing(whole, least))
        splits = F.coalesce(F.col("size") <= F.col("up") * WHOLE, F.lit(True))
        large = (F.col("size") > LARGE) & splits
        direct.append(_block_links(open_.where((F.col("size") > SMALL) & (F.col("size") <= LARGE)), sets, percent))
        rest.append(open_.where((F.col("size") > LARGE) & ~splits).select("node"))
        more = open_.where(large)
        if not more.head(1):
            break
        deeper = _more_paths(more.join(sk, "node"), similarity)
        again = deeper.groupBy("path").agg(F.count("*").alias("size")).where("size > 1").select("path")
        here = stored(_spread(deeper, again, "path"))
    unsplit = reduce(DataFrame.unionAll, rest).distinct()
    members = unsplit.join(nodes.select("node", "n"), "node").join(comp, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"), "n").join(sets, "node")
    pairs = _index_pairs(members, percent)
    pairs = pairs.join(sk.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a").join(sk.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b")
    likely = stored(reduce(DataFrame.unionAll, [*found, _likely(pairs, least).select("a", "b")]).distinct())
    more = stored(_confirmed(likely, sets, percent).unionAll(reduce(DataFrame.unionAll, direct)))
    if more.head(1):
        comp = components(links.unionAll(more))
    return rows.select("key", "r1", "r2", "n", "node"), comp


def near_duplicates(df: DataFrame, size: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id and kept of every row."""
    text = F.col(text_col).cast("string")
    rows, comp = linked_sets(df.select(F.col(id_col).alias("key"), *row_hash(F.col(id_col), text), text.alias("text")), size, percent)
    of_node = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("key").alias("first")).join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = of_node.groupBy("comp").agg(F.min("first").alias("component_id"))
    label = stored(of_node.join(least, "comp").select("node", "component_id"))
    out = rows.join(label, "node", "left").select("key", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("key") == F.col("component_id"), F.lit(False))).withColumnRenamed("key", id_col)


def keep_one(df: DataFrame, size: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near duplicates, that of the least id (a null id last), with all columns. Rows without words all stay."""
    k1, k2 = free_names(df, "r1", "r2")
    text = F.col(text_col).cast("string")
    h1, h2 = row_hash(F.col(id_col), text)
    marked = df.select("*", h1.alias(k1), h2.alias(k2))
    rows, comp = linked_sets(df.select(F.col(id_col).alias("key"), h1, h2, text.alias("text")), size, percent)
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "r1", "r2")).alias("first")
    of_node = rows.where("node IS NOT NULL").groupBy("node").agg(first).join(comp, "node", "left")
    kept = of_node.groupBy(F.coalesce("comp", "node").alias("comp")).agg(F.min("first").alias("first")).select("first.r1", "first.r2")
    kept = stored(kept.unionAll(rows.where("n = 0").select("r1", "r2").distinct()).toDF(k1, k2))
    out = marked.join(kept, [k1, k2], "left_semi")
    words = F.trim(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")) != ""
    if rows.where("n > 0").groupBy("r1", "r2").count().where("count > 1").head(1):
        # rows that repeat both id and text: one of them stays
        out = out.where(words).dropDuplicates([k1, k2]).unionAll(out.where(~words))
    return out.select(*df.columns)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


ORACLE_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.a, r.c FROM r JOIN e ON e.b = r.doc_id),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
"""
