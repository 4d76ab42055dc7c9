"""SQL texts give the rows that the DataFrame functions give."""

import random

import pytest
from pyspark.sql import functions as F

from talkweave import sql
from talkweave.functions import text as tx
from talkweave.functions import timeline as tl
from talkweave.operators import rules


@pytest.fixture(scope="module")
def responses(spark):
    rng = random.Random(8)
    bits = ["[S1] ", "[S2]", "[S0]", "---", " --- ", "\n", "\r\n", " ", "how are you", "Fine.", "(laughs)", "[sighs]", " - ", ":", "’s it's", "é x", "", "no end", "What? ", "\t"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 25)))) for i in range(500)] + [(500, None), (501, "[S1]: a\n---\n[S2] b")]
    sql.register(spark)
    spark.createDataFrame(rows, "id long, response string").createOrReplaceTempView("tw_responses")
    return spark.table("tw_responses")


def same(a, b):
    assert sorted(map(repr, map(tuple, a.collect()))) == sorted(map(repr, map(tuple, b.collect())))


def test_tables(spark, responses):
    same(spark.sql("SELECT r.id, b.* FROM tw_responses r, LATERAL tw_blocks(r.response) b"), responses.select("id", F.posexplode(tx.blocks(F.col("response"))).alias("block", "text")))
    want = responses.select("id", F.posexplode(tx.blocks(F.col("response"))).alias("block", "b")).select("id", "block", F.posexplode(tx.parse_turns(F.col("b"))).alias("turn", "t")).select("id", "block", "turn", "t.speaker", "t.text")
    same(spark.sql("SELECT r.id, b.* FROM tw_responses r, LATERAL tw_parse_blocks(r.response) b"), want)
    assert want.count() > 100
    assert [tuple(r) for r in spark.sql("SELECT * FROM tw_parse_blocks('[S1] Hi there\n[S2] Well.\n---\n[S2] how so')").collect()] == [(0, 0, "S0", "Hi there."), (0, 1, "S1", "Well."), (1, 0, "S1", "how so?")]


def test_scalars(spark, responses):
    r = F.col("response")
    same(
        spark.sql("SELECT id, tw_strip(response), tw_sanitize(response), tw_words(response), tw_space_words(response), tw_turn_fault(response), tw_short_reason(concat(response, ':', repeat(response, 9))) FROM tw_responses WHERE response IS NOT NULL"),
        responses.where(r.isNotNull()).select("id", tx.strip(r), tx.sanitize(r), tx.words(r), tx.space_words(r), rules.turn_fault(r), tx.short_reason(F.concat(r, F.lit(":"), F.repeat(r, F.lit(9))))),
    )
    scripts = responses.select("id", F.explode(tx.blocks(r)).alias("b")).select("id", tx.parse_turns(F.col("b")).alias("turns"))
    scripts.createOrReplaceTempView("tw_scripts")
    t = F.col("turns")
    same(spark.sql("SELECT id, tw_alternates(turns), tw_has_empty_turn(turns), tw_script_fault(turns) FROM tw_scripts"), scripts.select("id", rules.alternates(t), rules.has_empty_turn(t), rules.script_fault(t)))
    numbers = spark.range(60).select("id", F.get(F.array(*map(F.lit, tl.KINDS)), (F.col("id") % 3).cast("int")).alias("kind"), (F.col("id") * 137).alias("n"))
    numbers.createOrReplaceTempView("tw_numbers")
    same(
        spark.sql("SELECT id, tw_overlap_ms(kind, n), tw_turn_samples(n, 24000), tw_samples_ms(n, 24000), tw_estimate(n, id), tw_conversation_id(kind, id), tw_speaker_tag(concat('S', id % 2)) FROM tw_numbers"),
        numbers.select("id", tl.overlap_ms(F.col("kind"), F.col("n")), tl.turn_samples(F.col("n"), 24000), tl.samples_ms(F.col("n"), 24000), tx.estimate(F.col("n"), F.col("id")), tx.conversation_id(F.col("kind"), F.col("id")), tx.tag(F.concat(F.lit("S"), (F.col("id") % 2).cast("string")))),
    )


def test_native(spark, responses):
    """No Python in the plan."""
    plan = spark.sql("SELECT b.*, tw_turn_fault(b.text) FROM tw_responses r, LATERAL tw_parse_blocks(r.response) b")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Generate" in plan
