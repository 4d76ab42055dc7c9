"""The queries as they are registered, on the smallest of the given tables."""

import hashlib
import io
import os
import re
import wave
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__
from talkweave.llm import bpe
from talkweave.llm import queries as llm
from tests.llm.test_lines_and_samples import brute_sample
from tests.llm.test_small import PATTERNS, brute_components, brute_removed, passes
from tests.test_queries import DATA, TABLES, rows

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
TABLE = {"op2_html": ("pages", "page_id"), "op9_warc": ("pages", "page_id"), "op3_topk": ("embeddings", "vec_id"), "op12_hard_negatives": ("embeddings", "vec_id")}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def test_registered():
    assert set(llm.queries()) | {"pipeline"} <= set(__spark_entry__.queries()) and set(llm.oracle_sql()) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(llm.queries()))
def test_query(spark, duck, name):
    """Each runs over its whole table; the same as its SQL where it has one."""
    got = llm.queries()[name](spark, DATA).toPandas()
    table, key = TABLE.get(name, ("documents", "doc_id"))
    ids = {r[0] for r in duck.execute(f"SELECT {key} FROM {table}").fetchall()}
    if name == "op3_topk":
        ids = {i for i in ids if i % 100 == 0}
        key = "query_id"
    if name == "op12_hard_negatives":  # an anchor may have none
        ids = {i for i in ids if i % 100 == 0} & set(got["anchor_id"])
        key = "anchor_id"
    assert set(got[key]) == ids and ids
    if name in llm.oracle_sql():
        assert rows(got) == rows(duck.execute(llm.oracle_sql()[name]).df())
    if name == "op8_langid":
        truth = dict(duck.execute("SELECT doc_id, lang FROM documents WHERE lang IS NOT NULL").fetchall())
        held = got[got["held_out"] & got["doc_id"].isin(truth.keys())]
        assert len(held) > 20 and (held["lang_pred"] == held["doc_id"].map(truth)).mean() >= 0.98
        assert got["score"].between(0, 1).all()


def test_queries_against_brute_force(spark, duck):
    docs = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    got = llm.queries()["op4_near_dedup"](spark, DATA).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute_components(docs, 3, 85))
    got = llm.queries()["op5_suffix_dedup"](spark, DATA).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute_removed(docs, 200))
    got = llm.queries()["op11_resample"](spark, DATA).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, brute_sample(docs, [t for (t,) in duck.execute("SELECT text FROM benchmark").fetchall()])))


def test_values_of_whole_tables(spark, duck):
    """op1, op6, op7 and op10 value by value on the whole table, by the wave module, the tokenizers library and plain patterns."""
    docs = dict(duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    sha = lambda x: hashlib.sha256(x).hexdigest()
    for r in llm.queries()["op1_media"](spark, DATA).collect():
        raw = docs[r["doc_id"]].encode()
        p = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(1)
            w.setframerate(int(re.search(r"rate=(\d+)", r["feature"])[1]))
            w.writeframes(p)
        whole = out.getvalue()
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["media_bytes"], r["media_sha256"]) == (len(raw), len(p), sha(p), zlib.crc32(p[-64:]), len(whole), sha(whole))
    t = Tokenizer.from_file(bpe.tokenizer_path())
    ids = {k: t.encode(x, add_special_tokens=False).ids for k, x in docs.items()}
    got = {r["doc_id"]: tuple(r)[1:] for r in llm.queries()["op10_bpe"](spark, DATA).collect()}
    assert got == {k: (len(e), sha(" ".join(map(str, e)).encode()), sha(t.decode(e, skip_special_tokens=False).encode())) for k, e in ids.items()}
    cover, windows = defaultdict(list), defaultdict(list)
    for r in llm.queries()["op6_packing"](spark, DATA).collect():
        whole = np.array([*ids[r["doc_id"]], 2], "<u4")
        assert r["doc_tokens"] == len(whole) and r["ids_crc32"] == zlib.crc32(whole[r["start"] : r["start"] + r["length"]].tobytes())
        cover[r["doc_id"]].append((r["start"], r["length"]))
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    gapless = lambda parts: [a for a, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1].tolist()]
    assert all(gapless(p) and sum(n for _, n in p) == len(ids[k]) + 1 for k, p in cover.items()) and set(cover) == set(docs)
    assert all(gapless(p) and sum(n for _, n in p) <= 4096 for p in windows.values())
    total = sum(len(x) + 1 for x in ids.values())
    assert len(windows) * 4096 < total + 2 * 4096 * max(1, sum(map(len, docs.values())) // (16 << 20) + 1)
    for r in llm.queries()["op7_pii"](spark, DATA).collect():
        found = sorted((m.start(), i, f"{kind}:{m.start()}:{m.end()}") for i, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, docs[r["doc_id"]]) if passes(kind, m[0]))
        assert r["base_sha256"] == sha(",".join(x[2] for x in found).encode()) and {x[2] for x in found} <= set(r["spans"].split(","))
        assert tuple(r)[1:5] == tuple(sum(x[1] == i for x in found) for i in range(4))
