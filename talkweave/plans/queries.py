"""Queries over the given tables, each with its SQL.

Scripts come from the conversations table. Its texts break few rules, so some are spoiled on both sides: every third
conversation gets a stage direction, of the others every fifth loses its last character.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkweave.config import DEFAULT_BUCKETS, Bucket, bucket_table
from talkweave.functions import text as tx
from talkweave.functions import tokens as tk
from talkweave.operators import corpus, dialogue, duplex, generation, quantiles, rules, training, validate
from talkweave.operators.ordinal import ordinal, ordinal_within
from talkweave.operators.rules import judged_turns
from talkweave.streaming import endpoints

#: Buckets that conversations of the given tables do meet.
WIDE = tuple(Bucket(b.name, b.count, b.turn_min, b.turn_max, 1, 600, b.duration_avg_sec, 1, 2000, "") for b in DEFAULT_BUCKETS[:3])

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def raw_turns(spark: SparkSession, d: str) -> DataFrame:
    return dialogue.from_messages(spark.read.parquet(f"{d}/conversations.parquet"))


def spoiled(turns: DataFrame) -> DataFrame:
    t = F.col("text")
    return turns.withColumn("text", F.when(F.col("conv_id") % 3 == 0, F.concat(t, F.lit(" (laughs)"))).when(F.col("conv_id") % 5 == 0, F.substring(t, F.lit(1), F.length(t) - 1)).otherwise(t))


def turns(spark: SparkSession, d: str) -> DataFrame:
    return spoiled(raw_turns(spark, d))


def timed(spark: SparkSession, d: str) -> DataFrame:
    return dialogue.timeline(raw_turns(spark, d))


def plan(spark: SparkSession, d: str) -> DataFrame:
    return dialogue.overlap_plan(timed(spark, d))


# --- SQL parts

WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
RAW_SQL = """
raw AS (
  SELECT conv_id, turn, CASE role WHEN 'user' THEN 'S0' ELSE 'S1' END AS speaker, text,
         count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role IN ('user', 'assistant')),
rt AS (
  SELECT conv_id, turn, speaker, text, CASE WHEN n BETWEEN 4 AND 5 THEN 'short' WHEN n BETWEEN 6 AND 7 THEN 'medium' WHEN n = 8 THEN 'long' ELSE 'other' END AS category FROM raw)"""
TURNS_SQL = f"""{RAW_SQL},
t AS (
  SELECT conv_id, turn, speaker, category, CASE WHEN conv_id % 3 = 0 THEN text || ' (laughs)' WHEN conv_id % 5 = 0 THEN left(text, CAST(length(text) - 1 AS BIGINT)) ELSE text END AS text FROM rt)"""


def sanitize_sql(x: str) -> str:
    masked = rf"regexp_replace(regexp_replace({x}, '\([^)]*\)', '', 'g'), '\[S([012])\]', chr(1) || '\1' || chr(2), 'g')"
    plain = rf"replace(replace(regexp_replace({masked}, '\[[^\]]+\]', '', 'g'), chr(1), '[S'), chr(2), ']')"
    lead = rf"regexp_replace({plain}, '^({WS}|[:：–—-])+', '')"
    spaced = rf"regexp_replace(regexp_replace({lead}, '{WS}+', ' ', 'g'), '^ | $', '', 'g')"
    return spaced


def ended_sql(x: str) -> str:
    return rf"CASE WHEN {x} = '' OR regexp_matches({x}, '[.!?]$') THEN {x} WHEN regexp_matches(lower({x}), '^({tx.INTERROGATIVES.replace(' ', '|')}) ') THEN {x} || '?' ELSE {x} || '.' END"


WORDS_SQL = r"len(regexp_extract_all({0}, '[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_'']*'))"
SPACED_SQL = "len(list_filter(regexp_split_to_array({0}, '" + WS.replace("{", "{{").replace("}", "}}") + "+'), lambda w: w <> ''))"


def words_sql(x: str) -> str:
    return WORDS_SQL.format(x)


def spaced_sql(x: str) -> str:
    return SPACED_SQL.format(x)


def bucket_sql(name: str, buckets: tuple[Bucket, ...]) -> str:
    rows = ", ".join(f"('{b.name}', {i}, {b.count}, {b.turn_min}, {b.turn_max}, CAST({b.duration_min_sec} AS DOUBLE), CAST({b.duration_max_sec} AS DOUBLE), CAST({b.duration_avg_sec} AS DOUBLE), {b.words_min}, {b.words_max})" for i, b in enumerate(buckets))
    return f"{name} AS (SELECT * FROM (VALUES {rows}) v(name, pos, count, turn_min, turn_max, duration_min_sec, duration_max_sec, duration_avg_sec, words_min, words_max))"


def verdict_sql(buckets: tuple[Bucket, ...]) -> str:
    return rf"""{TURNS_SQL}, {bucket_sql("b", buckets)},
f AS (SELECT *, CASE WHEN regexp_matches(text, '\([^)]*\)') OR regexp_matches(regexp_replace(text, '\[S[012]\]', '', 'g'), '\[[^\]]+\]') THEN 'contains stage directions'
                     WHEN NOT regexp_matches(text, '[.!?]$') THEN 'turn is missing terminal punctuation' END AS fault,
             {words_sql("text")} AS w, {spaced_sql("text")} AS s, length(text) - length(replace(text, '(', '')) AS o FROM t),
p AS (SELECT conv_id, any_value(category) AS category, count(*) AS n_turns, sum(w) AS n_words, sum(s) AS s, sum(o) AS o, arg_min(fault, CASE WHEN fault IS NOT NULL THEN turn END) AS fault FROM f GROUP BY conv_id),
v AS (SELECT conv_id, category, n_turns, CAST(n_words AS BIGINT) AS n_words, CASE
  WHEN name IS NULL THEN 'unknown category'
  WHEN n_turns NOT BETWEEN turn_min AND turn_max THEN 'has ' || n_turns || ' turns, expected ' || turn_min || '-' || turn_max
  WHEN n_words NOT BETWEEN words_min AND words_max THEN 'has ' || n_words || ' words, expected ' || words_min || '-' || words_max
  WHEN fault IS NOT NULL THEN fault
  WHEN greatest(1.0::DOUBLE, s / 2.6::DOUBLE + o * 0.4::DOUBLE) NOT BETWEEN duration_min_sec * 0.25::DOUBLE AND duration_max_sec * 1.5::DOUBLE THEN 'estimated duration is outside prompt tolerance' END AS reason
  FROM p LEFT JOIN b ON name = category)"""


TIMED_SQL = f"""{RAW_SQL},
d AS (SELECT *, CAST(floor(greatest(0.6::DOUBLE, greatest({spaced_sql("text")}, 1) / 2.8::DOUBLE) * 24000) AS BIGINT) AS samples FROM rt),
m AS (SELECT *, CAST(round_even(samples / 24000::DOUBLE * 1000, 0) AS BIGINT) AS ms FROM d),
tl AS (SELECT *, CAST(coalesce(sum(ms + 100) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_ms FROM m),
ti AS (SELECT *, start_ms + ms AS end_ms FROM tl)"""
DRAW_SQL = "(('0x' || left(sha1('13:{0}' || conv_id), 8))::BIGINT / 4294967296::DOUBLE)"
PLAN_SQL = f"""{TIMED_SQL},
pr AS (SELECT conv_id, turn, ms, speaker <> lag(speaker) OVER w AS alt, lag(turn) OVER w AS turn_a, lag(start_ms) OVER w AS a_start, lag(end_ms) OVER w AS a_end, count(*) OVER (PARTITION BY conv_id) AS n
       FROM ti WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
ca AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS r FROM pr WHERE n >= 3 AND alt),
ch AS (SELECT *, {DRAW_SQL.format("kind")} AS u FROM ca WHERE r = floor({DRAW_SQL.format("turn")} * c)),
ki AS (SELECT *, CASE WHEN u < 0.7::DOUBLE THEN 'backchannel' WHEN u < 0.7::DOUBLE + 0.25::DOUBLE THEN 'interruption' ELSE 'simultaneous_start' END AS kind FROM ch),
sh AS (SELECT *, CASE kind WHEN 'simultaneous_start' THEN a_start
    WHEN 'interruption' THEN greatest(a_start, a_end - least(greatest(ms // 2, 500), 1400))
    ELSE greatest(a_start + 250, a_end - least(greatest(ms // 2, 300), 900)) END AS new_start FROM ki),
pl AS (SELECT conv_id, kind, turn_a, turn AS turn_b, new_start, new_start + ms AS new_end, greatest(a_start, new_start) AS overlap_start_ms, least(a_end, new_start + ms) AS overlap_end_ms FROM sh
       WHERE least(a_end, new_start + ms) > greatest(a_start, new_start))"""
SHIFTED_SQL = f"""{PLAN_SQL},
st AS (SELECT ti.conv_id, ti.turn, speaker, text, CASE WHEN ti.turn = turn_b THEN new_start ELSE start_ms END AS start_ms, CASE WHEN ti.turn = turn_b THEN new_end ELSE end_ms END AS end_ms FROM ti JOIN pl USING (conv_id))"""


# --- text and rules


@query(f"WITH {TURNS_SQL}, c AS (SELECT conv_id, turn, {sanitize_sql('text')} AS s FROM t) SELECT conv_id, turn, {ended_sql('s')} AS text FROM c")
def turn_sanitize(spark, d):
    return turns(spark, d).select("conv_id", "turn", tx.sanitize(F.col("text")).alias("text"))


@query(f"WITH {TURNS_SQL} SELECT conv_id, CAST(sum({words_sql('text')}) AS BIGINT) AS n_words, CAST(sum({spaced_sql('text')}) AS BIGINT) AS n_spaced, round(greatest(1.0::DOUBLE, sum({spaced_sql('text')}) / 2.6::DOUBLE + sum(length(text) - length(replace(text, '(', ''))) * 0.4::DOUBLE), 6) AS seconds FROM t GROUP BY conv_id")
def script_words(spark, d):
    t = turns(spark, d).groupBy("conv_id").agg(F.sum(tx.words(F.col("text"))).alias("n_words"), F.sum(tx.space_words(F.col("text"))).alias("n_spaced"), F.sum(tx.openings(F.col("text"))).alias("o"))
    return t.select("conv_id", "n_words", "n_spaced", F.round(tx.estimate(F.col("n_spaced"), F.col("o")), 6).alias("seconds"))


@query(f"WITH {verdict_sql(DEFAULT_BUCKETS)} SELECT * FROM v")
def script_verdict(spark, d):
    return judged_turns(turns(spark, d), bucket_table(spark))


@query(f"WITH {verdict_sql(WIDE)} SELECT * FROM v")
def script_verdict_wide(spark, d):
    return judged_turns(turns(spark, d), bucket_table(spark, WIDE))


@query(f"WITH {verdict_sql(WIDE)} SELECT category, coalesce(reason, 'accepted') AS reason, count(*) AS n FROM v GROUP BY ALL")
def verdict_histogram(spark, d):
    v = judged_turns(turns(spark, d), bucket_table(spark, WIDE))
    return v.groupBy("category", F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH {verdict_sql(WIDE)}, c AS (SELECT category, reason, count(*) AS n FROM v WHERE reason IS NOT NULL GROUP BY ALL) SELECT category, string_agg(reason || ' x' || n, ', ' ORDER BY reason COLLATE \"C\") AS reasons FROM c GROUP BY category".replace(' COLLATE "C"', ""))
def reject_reasons(spark, d):
    v = judged_turns(turns(spark, d), bucket_table(spark, WIDE)).where("reason IS NOT NULL").groupBy("category", "reason").agg(F.count("*").alias("n"))
    return v.groupBy("category").agg(tx.reason_list(F.collect_list(F.struct("reason", "n"))).alias("reasons"))


@query(f"WITH {verdict_sql(WIDE)}, e AS ({bucket_sql('x', DEFAULT_BUCKETS).removeprefix('x AS (').removesuffix(')')}) SELECT e.name AS category, count(conv_id) AS accepted, any_value(e.count) - count(conv_id) AS missing FROM e LEFT JOIN v ON v.category = e.name AND reason IS NULL GROUP BY e.name")
def bucket_counts(spark, d):
    done = judged_turns(turns(spark, d), bucket_table(spark, WIDE)).where("reason IS NULL").groupBy("category").agg(F.count("*").alias("n"))
    b = bucket_table(spark).select("name", "count")
    return b.join(done, b["name"] == done["category"], "left").select(F.col("name").alias("category"), F.coalesce("n", F.lit(0)).alias("accepted"), (F.col("count") - F.coalesce("n", F.lit(0))).alias("missing"))


@query(f"WITH {verdict_sql(WIDE)}, i AS (SELECT category || '_' || lpad(CAST(row_number() OVER (PARTITION BY category ORDER BY conv_id) - 1 AS VARCHAR), 6, '0') AS conversation_id, conv_id FROM v WHERE reason IS NULL) SELECT * FROM i")
def id_assign(spark, d):
    good = judged_turns(turns(spark, d), bucket_table(spark, WIDE)).where("reason IS NULL").select("conv_id", "category")
    return ordinal_within(good, "category", "conv_id").select(tx.conversation_id(F.col("category"), F.col("idx")).alias("conversation_id"), "conv_id")


@query(f"WITH {RAW_SQL} SELECT DISTINCT conv_id FROM rt WHERE conv_id NOT IN (SELECT conv_id FROM rt WHERE turn = 0 AND conv_id % 4 = 0)")
def resume_antijoin(spark, d):
    t = raw_turns(spark, d)
    done = t.where("turn = 0 AND conv_id % 4 = 0").select("conv_id")
    return t.select("conv_id").distinct().join(done, "conv_id", "left_anti")


@query(f"WITH {RAW_SQL}, n AS (SELECT category AS bucket, count(DISTINCT conv_id) AS have FROM rt GROUP BY category), l AS (SELECT sum(have) * 3 // 5 AS lim FROM n), s AS (SELECT bucket, have, lim, coalesce(sum(have) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n, l) SELECT bucket AS category, have, CAST(greatest(0, least(have, lim - before)) AS BIGINT) AS target FROM s")
def bucket_fill_limit(spark, d):
    """A limit of three fifths of all conversations, filled in the order of their buckets; buckets are a handful of counts."""
    have = raw_turns(spark, d).groupBy(F.col("category").alias("bucket")).agg(F.countDistinct("conv_id").alias("have"))
    return generation.filled(have, "bucket", "have", F.floor(F.sum("have").over(Window.partitionBy()) * 3 / 5)).select(F.col("bucket").alias("category"), "have", "target")


@query(f"WITH {RAW_SQL}, x AS (SELECT conv_id, turn FROM rt UNION ALL SELECT conv_id, turn + 100 FROM rt WHERE turn = 1 AND conv_id % 7 = 0), o AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS occurrence FROM x) SELECT conv_id, turn, occurrence FROM o WHERE occurrence > 1")
def duplicate_ids(spark, d):
    t = raw_turns(spark, d).select("conv_id", "turn")
    both = t.unionAll(t.where("turn = 1 AND conv_id % 7 = 0").select("conv_id", (F.col("turn") + 100).alias("turn")))
    return validate.duplicates(both, "conv_id", "turn").withColumn("occurrence", F.col("occurrence").cast("long"))


@query(f"WITH {RAW_SQL}, x AS (SELECT conv_id, turn, CASE WHEN conv_id % 6 = 0 THEN 'S0' ELSE speaker END AS speaker FROM rt), y AS (SELECT *, lag(speaker) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM x) SELECT conv_id, turn FROM y WHERE p = speaker")
def alternation_check(spark, d):
    t = raw_turns(spark, d).withColumn("speaker", F.when(F.col("conv_id") % 6 == 0, "S0").otherwise(F.col("speaker")))
    return t.withColumn("p", F.lag("speaker").over(dialogue.by_turn())).where("p = speaker").select("conv_id", "turn")


@query(f"WITH {TURNS_SQL} SELECT conv_id, string_agg(CASE speaker WHEN 'S0' THEN '[S1] ' ELSE '[S2] ' END || text, ' ' ORDER BY turn) AS text FROM t GROUP BY conv_id")
def linearize(spark, d):
    return dialogue.linear_texts(turns(spark, d))


BLOCKS_SQL = rf"""WITH {TURNS_SQL},
k AS (SELECT conv_id, string_agg('[' || CASE speaker WHEN 'S0' THEN 'S1' ELSE 'S2' END || ']: ' || text, chr(10) ORDER BY turn) AS block FROM t GROUP BY conv_id),
r AS (SELECT conv_id // 3 AS response_id, string_agg(block, chr(10) || ' --- ' || chr(10) ORDER BY conv_id) AS response FROM k GROUP BY ALL),
b AS (SELECT response_id, regexp_replace(unnest(x), '^{WS}+|{WS}+$', '', 'g') AS text, generate_subscripts(x, 1) - 1 AS block FROM (SELECT response_id, list_filter(regexp_split_to_array(response, '(?m)^\s*---\s*$'), lambda p: regexp_matches(p, '[^\s]')) AS x FROM r)),
l AS (SELECT response_id, block, regexp_replace(unnest(y), '^{WS}+|{WS}+$', '', 'g') AS line, generate_subscripts(y, 1) AS i FROM (SELECT response_id, block, regexp_split_to_array(text, '\r\n|[\n\r\x{{0b}}\x{{0c}}\x{{1c}}\x{{1d}}\x{{1e}}\x{{85}}\x{{2028}}\x{{2029}}]') AS y FROM b)),
g AS (SELECT response_id, block, i, CASE regexp_extract(line, '^\[(S0|S1|S2)\]\s*(.+)$', 1) WHEN 'S2' THEN 'S1' ELSE 'S0' END AS speaker, {sanitize_sql("regexp_extract(line, '^\\[(S0|S1|S2)\\]\\s*(.+)$', 2)")} AS s FROM l WHERE regexp_matches(line, '^\[(S0|S1|S2)\]\s*(.+)$')),
h AS (SELECT response_id, block, speaker, i, {ended_sql("s")} AS text FROM g)
SELECT response_id, CAST(block AS BIGINT) AS block, CAST(row_number() OVER (PARTITION BY response_id, block ORDER BY i) - 1 AS BIGINT) AS turn, speaker, text FROM h"""


def _responses(spark, d) -> DataFrame:
    """response_id, response: three conversations each, in blocks."""
    line = F.struct("turn", F.concat(F.lit("["), F.when(F.col("speaker") == "S0", "S1").otherwise("S2"), F.lit("]: "), F.col("text")).alias("s"))
    block = turns(spark, d).groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["s"]), "\n").alias("block"))
    response = block.groupBy(F.floor(F.col("conv_id") / 3).alias("response_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("conv_id", "block"))), lambda x: x["block"]), "\n --- \n").alias("response"))
    return response


@query(BLOCKS_SQL)
def block_split_parse(spark, d):
    each = _responses(spark, d).select("response_id", F.posexplode(tx.blocks(F.col("response"))).alias("block", "text"))
    return each.select("response_id", F.col("block").cast("long").alias("block"), F.posexplode(tx.parse_turns(F.col("text"))).alias("turn", "x")).select("response_id", "block", F.col("turn").cast("long").alias("turn"), "x.speaker", "x.text")


@query(f"""WITH {RAW_SQL}, p AS (SELECT r_name AS a, row_number() OVER (ORDER BY r_name) - 1 AS p_idx FROM region), n AS (SELECT count(*) AS n FROM region),
s AS (SELECT conv_id, any_value(category) AS category, string_agg(CASE speaker WHEN 'S0' THEN '[S1] ' ELSE '[S2] ' END || text, ' ' ORDER BY turn) AS text FROM rt GROUP BY conv_id),
i AS (SELECT *, row_number() OVER (ORDER BY conv_id) - 1 AS idx FROM s)
SELECT conv_id || '.wav' AS wav, 'I am ' || a AS s1_prompt_transcription, a || '.wav' AS s1_prompt_wav, text FROM i, n JOIN p ON idx % n = p_idx WHERE category <> 'other'""")
def tsv_export(spark, d):
    bank = spark.read.parquet(f"{d}/region.parquet").select(F.col("r_name").alias("path"), F.concat(F.lit("I am "), "r_name").alias("s1_prompt_transcription"), F.concat("r_name", F.lit(".wav")).alias("s1_prompt_wav"))
    t = raw_turns(spark, d)
    scripts = dialogue.linear_texts(t).join(t.groupBy("conv_id").agg(F.first("category").alias("category")), "conv_id")
    return corpus.with_prompts(scripts, bank, "conv_id").where("category <> 'other'").select(F.concat(F.col("conv_id").cast("string"), F.lit(".wav")).alias("wav"), "s1_prompt_transcription", "s1_prompt_wav", "text")


# --- timelines and overlaps


@query(f"WITH {TIMED_SQL} SELECT conv_id, turn, samples, ms, start_ms, end_ms FROM ti")
def stage3_timeline(spark, d):
    return timed(spark, d).select("conv_id", "turn", "samples", "ms", "start_ms", "end_ms")


@query(f"WITH {TIMED_SQL}, {bucket_sql('b', WIDE)}, s AS (SELECT conv_id, any_value(category) AS category, CAST(sum(samples) + (count(*) - 1) * 2400 AS BIGINT) AS total_samples FROM ti GROUP BY conv_id) SELECT category, count(*) AS n, CAST(sum(CASE WHEN total_samples / 24000::DOUBLE BETWEEN duration_min_sec AND duration_max_sec THEN 1 ELSE 0 END) AS BIGINT) AS written, CAST(sum(CASE WHEN total_samples / 24000::DOUBLE BETWEEN duration_min_sec AND duration_max_sec THEN 0 ELSE 1 END) AS BIGINT) AS skipped FROM s LEFT JOIN b ON name = category GROUP BY category")
def stage3_accept(spark, d):
    b = bucket_table(spark, WIDE)
    s = dialogue.mixed_duration(raw_turns(spark, d)).join(F.broadcast(b), F.col("category") == F.col("name"), "left")
    ok = F.coalesce((F.col("total_samples") / 24000).between(F.col("duration_min_sec"), F.col("duration_max_sec")), F.lit(False)).cast("long")
    return s.groupBy("category").agg(F.count("*").alias("n"), F.sum(ok).alias("written"), F.sum(1 - ok).alias("skipped"))


@query(f"WITH {PLAN_SQL} SELECT * FROM pl")
def overlap_plan(spark, d):
    return plan(spark, d)


@query(f"WITH {PLAN_SQL} SELECT kind, count(*) AS n, CAST(sum(overlap_end_ms - overlap_start_ms) AS BIGINT) AS total_ms, min(overlap_end_ms - overlap_start_ms) AS least_ms, max(overlap_end_ms - overlap_start_ms) AS most_ms FROM pl GROUP BY kind")
def overlap_stats(spark, d):
    ms = F.col("overlap_end_ms") - F.col("overlap_start_ms")
    return plan(spark, d).groupBy("kind").agg(F.count("*").alias("n"), F.sum(ms).alias("total_ms"), F.min(ms).alias("least_ms"), F.max(ms).alias("most_ms"))


def _shifted(spark, d):
    t = timed(spark, d)
    return dialogue.shifted_timeline(t, dialogue.overlap_plan(t))


@query(f"WITH {SHIFTED_SQL}, o AS (SELECT *, lag(end_ms, 1, -1) OVER (PARTITION BY conv_id ORDER BY turn) AS previous_end_ms FROM st) SELECT conv_id, turn, start_ms, previous_end_ms FROM o WHERE start_ms < previous_end_ms")
def stage4_order_violations(spark, d):
    return dialogue.order_violations(_shifted(spark, d))


@query(f"WITH {SHIFTED_SQL}, o AS (SELECT *, max(end_ms) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM st), s AS (SELECT conv_id, greatest(0, least(coalesce(reach, end_ms), end_ms) - CASE WHEN reach IS NULL THEN end_ms ELSE start_ms END) AS x FROM o) SELECT conv_id, CAST(sum(CASE WHEN x > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_overlaps, CAST(sum(x) AS BIGINT) AS shared_ms FROM s GROUP BY conv_id")
def overlap_pairs_audit(spark, d):
    return dialogue.overlap_audit(_shifted(spark, d))


@query(f"WITH {SHIFTED_SQL}, f AS (SELECT conv_id, speaker, unnest(range(start_ms // 80, (end_ms - 1) // 80 + 1)) AS frame FROM st), g AS (SELECT conv_id, frame, max(CASE speaker WHEN 'S0' THEN 1 ELSE 0 END) AS s0, max(CASE speaker WHEN 'S1' THEN 1 ELSE 0 END) AS s1 FROM f GROUP BY ALL) SELECT conv_id, count(*) AS spoken, CAST(sum(s0 * s1) AS BIGINT) AS both, max(frame) + 1 AS span FROM g GROUP BY conv_id")
def frame_streams(spark, d):
    return dialogue.speech_report(_shifted(spark, d))


@query(f"WITH {TIMED_SQL}, {bucket_sql('b', DEFAULT_BUCKETS)}, s AS (SELECT category, count(DISTINCT conv_id) AS n FROM ti GROUP BY category) SELECT name AS category, coalesce(n, 0) AS found, round(coalesce(n, 0) * duration_avg_sec / 3600, 6) AS found_hours, round(count * duration_avg_sec / 3600, 6) AS planned_hours FROM b LEFT JOIN s ON name = category")
def expected_hours(spark, d):
    n = raw_turns(spark, d).groupBy("category").agg(F.countDistinct("conv_id").alias("n"))
    b = bucket_table(spark)
    hours = lambda c: F.round(c * F.col("duration_avg_sec") / 3600, 6)
    return b.join(n, b["name"] == n["category"], "left").select(F.col("name").alias("category"), F.coalesce("n", F.lit(0)).alias("found"), hours(F.coalesce("n", F.lit(0))).alias("found_hours"), hours(F.col("count")).alias("planned_hours"))


@query("""WITH e AS (SELECT user_id, event_type, value, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS us FROM events WHERE ts IS NOT NULL)
SELECT event_type, count(*) AS items, CAST(sum(us) AS BIGINT) AS wall_us, round(sum(value), 6) AS audio_sec, CAST(sum(greatest(1, CAST(floor(value * 12.5::DOUBLE) AS BIGINT))) AS BIGINT) AS frames,
  round(sum(value) / greatest(sum(us) / 1000000::DOUBLE, 0.000001), 6) AS speed FROM e WHERE us IS NOT NULL GROUP BY event_type""")
def rtf_estimate(spark, d):
    """Of a log of work, which events are: an item took from its user's event before to its own time, for as many seconds as its value."""
    e = spark.read.parquet(f"{d}/events.parquet").where("ts IS NOT NULL")
    at = F.unix_micros(F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("Z"))))  # no session's zone or summer time plays a part
    us = at - F.lag(at).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    log = e.select("event_type", "value", us.alias("us")).where("us IS NOT NULL")
    return corpus.real_time(log.withColumnRenamed("value", "audio_sec"), "event_type").withColumns({"audio_sec": F.round("audio_sec", 6), "speed": F.round("speed", 6)})


# --- codes and sequences, of embeddings (conv_id is vec_id): the component x at codebook * 17 + frame * 7 (around the vector) gives floor(1024 * x) modulo 2048, and 0 where it is
# null or not finite; frames = 5 + conv_id % 11 (codebook 15 one more)


def codes_sql(k: int = 16) -> str:
    return f"""cd AS (SELECT conv_id, cb, frame, CAST(((c % 2048) + 2048) % 2048 AS INTEGER) AS code FROM (
  SELECT conv_id, cb, frame, CAST(floor(1024 * CASE WHEN isfinite(x) THEN CAST(x AS DOUBLE) ELSE 0 END) AS BIGINT) AS c FROM (
    SELECT vec_id AS conv_id, cb, f AS frame, embedding[1 + (cb * 17 + f * 7) % len(embedding)] AS x FROM embeddings, range({k}) a(cb), range(16) b(f) WHERE f < 5 + vec_id % 11 + CASE WHEN cb = 15 THEN 1 ELSE 0 END)))"""


CODES_SQL = codes_sql()


def coded(spark, d, k: int = 16) -> DataFrame:
    n = 5 + F.col("vec_id") % 11
    at = lambda cb, f: F.get("embedding", ((cb * 17 + f * 7) % F.size("embedding")).cast("int")).cast("double")
    finite = lambda x: F.when(F.abs(x) < float("inf"), x).otherwise(0.0)
    code = lambda cb, f: F.pmod(F.floor(1024 * finite(at(cb, f))), F.lit(tk.CODES)).cast("int")
    row = lambda cb: F.transform(F.sequence(F.lit(0), n - F.when(cb == 15, 0).otherwise(1)), lambda f: code(cb, f))
    vectors = spark.read.parquet(f"{d}/embeddings.parquet")
    return vectors.select(F.col("vec_id").alias("conv_id"), n.alias("n_frames"), F.transform(F.sequence(F.lit(0), F.lit(k - 1)), row).alias("codes"))


@query(f"WITH {CODES_SQL} SELECT conv_id, string_agg(code, ' ' ORDER BY frame, cb) AS flat FROM cd WHERE cb < 8 GROUP BY conv_id")
def codes_frame_major(spark, d):
    return coded(spark, d).select("conv_id", F.array_join(tk.frame_major(tk.first_codebooks(F.col("codes"), 8)), " ").alias("flat"))


@query(f"WITH {CODES_SQL} SELECT conv_id, count(DISTINCT cb) AS codebooks, CAST(sum(code) AS BIGINT) AS total, min(code) AS least, max(code) AS largest FROM cd WHERE cb < 8 GROUP BY conv_id")
def codes_slice(spark, d):
    c = coded(spark, d).select("conv_id", tk.first_codebooks(F.col("codes"), 8).alias("c")).select("conv_id", F.size("c").cast("long").alias("codebooks"), F.flatten("c").alias("x"))
    return c.select("conv_id", "codebooks", F.aggregate("x", F.lit(0).cast("long"), lambda a, v: a + v).alias("total"), F.array_min("x").alias("least"), F.array_max("x").alias("largest"))


@query(f"WITH {CODES_SQL} SELECT conv_id, cb, frame, code, lag(code, 1, 2048) OVER (PARTITION BY conv_id, cb ORDER BY frame) AS prev FROM cd")
def prev_frame(spark, d):
    return corpus.previous(corpus.long_codes(coded(spark, d))).select("conv_id", F.col("cb").cast("long").alias("cb"), F.col("frame").cast("long").alias("frame"), "code", "prev")


@query(f"""WITH {CODES_SQL}, n AS (SELECT conv_id, conv_id // 8 AS batch, least(5 + conv_id % 11, min(m)) AS own FROM (SELECT conv_id, cb, count(*) AS m FROM cd GROUP BY ALL) GROUP BY conv_id),
z AS (SELECT conv_id, list(code ORDER BY frame) AS l FROM cd WHERE cb = 0 GROUP BY conv_id),
f AS (SELECT *, least(max(own) OVER (PARTITION BY batch), 12) AS frames FROM n JOIN z USING (conv_id))
SELECT conv_id, batch, frames, (SELECT string_agg(CASE WHEN i < own THEN CAST(l[i + 1] AS VARCHAR) ELSE '-100' END, ' ' ORDER BY i) FROM range(16) r(i) WHERE i < frames) AS first_codes,
       least(own, frames) AS kept FROM f""")
def collate_mask(spark, d):
    out = corpus.collated(coded(spark, d), F.floor(F.col("conv_id") / 8), budget=12)
    return out.select("conv_id", "batch", "frames", F.array_join(F.get("codes", F.lit(0)), " ").alias("first_codes"), F.aggregate("code_mask", F.lit(0).cast("long"), lambda a, v: a + v).alias("kept"))


SEQUENCE_SQL = f"""{RAW_SQL}, {CODES_SQL},
tx AS (SELECT conv_id, string_agg('<|s' || right(speaker, 1) || '_text|> ' || array_to_string(list_filter(regexp_split_to_array(text, '{WS}+'), lambda w: w <> ''), ' ') || ' <|s' || right(speaker, 1) || '_audio|>', ' ' ORDER BY turn) AS a, CAST(sum({spaced_sql("text")} + 2) AS BIGINT) AS n FROM rt GROUP BY conv_id),
cs AS (SELECT conv_id, string_agg('<|mimi_' || code || '|>', ' ' ORDER BY frame, cb) AS b, count(*) AS k FROM cd WHERE cb < 8 GROUP BY conv_id)"""


def _sequences(spark, d, codes: Column | None = None) -> DataFrame:
    t = F.struct("turn", F.when(F.col("speaker") == "S0", 0).otherwise(1).alias("speaker"), "text")
    nested = raw_turns(spark, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(t)).alias("turns"))
    codes = tk.first_codebooks(F.col("codes"), 8) if codes is None else codes
    return corpus.sequences(coded(spark, d).select("conv_id", codes.alias("codes_training")), nested, ["conv_id"])


@query(f"WITH {SEQUENCE_SQL} SELECT conv_id, md5(a || ' ' || b) AS tokens_md5, n + k AS n_tokens FROM tx JOIN cs USING (conv_id)")
def training_sequence(spark, d):
    return _sequences(spark, d).select("conv_id", F.md5(F.array_join("tokens", " ")).alias("tokens_md5"), F.size("tokens").cast("long").alias("n_tokens"))


@query(f"""WITH {SEQUENCE_SQL}, kept AS (SELECT conv_id, n, CASE WHEN conv_id % 5 = 0 THEN 0 ELSE k END AS k FROM tx JOIN cs USING (conv_id))
SELECT conv_id, n + k AS mask_size, k AS mask_sum, CASE WHEN n + k = 0 THEN 1 ELSE 0 END + CASE WHEN k = 0 THEN 1 ELSE 0 END AS n_faults FROM kept""")
def mask_totals(spark, d):
    """Every fifth conversation loses its codes, so that its mask has nothing to train on."""
    s = _sequences(spark, d, F.when(F.col("conv_id") % 5 == 0, F.array().cast("array<array<int>>")).otherwise(tk.first_codebooks(F.col("codes"), 8)))
    return s.select("conv_id", F.size("loss_mask").cast("long").alias("mask_size"), F.aggregate("loss_mask", F.lit(0).cast("long"), lambda a, v: a + v).alias("mask_sum"), F.size(validate.sequence_faults(F.col("tokens"), F.col("loss_mask"))).alias("n_faults"))


@query(f"""WITH {codes_sql(32)}, s AS (SELECT conv_id, cb, frame, code + CASE WHEN conv_id % 9 <> 0 AND conv_id % 10 = 0 THEN 2048 ELSE 0 END AS code FROM cd WHERE NOT (conv_id % 9 = 0 AND cb = 31))
SELECT conv_id, 5 + conv_id % 11 AS n_frames, count(DISTINCT cb) = 32 AND bool_and(code BETWEEN 0 AND 2047) AND count(*) FILTER (WHERE cb = 0) = 5 + conv_id % 11 AS valid FROM s GROUP BY conv_id""")
def codec_row_checks(spark, d):
    rows = coded(spark, d, 32)
    spoiled_ = F.when(F.col("conv_id") % 9 == 0, F.slice("codes", 1, 31)).when(F.col("conv_id") % 10 == 0, F.transform("codes", lambda c: F.transform(c, lambda v: v + tk.CODES))).otherwise(F.col("codes"))
    return rows.select("conv_id", "n_frames", tk.codes_valid(spoiled_, F.col("n_frames")).alias("valid"))


@query(f"WITH {CODES_SQL}, p AS (SELECT *, lag(code, 1, 2048) OVER (PARTITION BY conv_id, cb ORDER BY frame) AS prev FROM cd) SELECT cb, count(*) AS n, count(DISTINCT code) AS distinct_codes, CAST(sum(CASE WHEN code = prev THEN 1 ELSE 0 END) AS BIGINT) AS repeats, min(code) AS least, max(code) AS largest FROM p GROUP BY cb")
def unique_codes(spark, d):
    return corpus.codebook_report(corpus.long_codes(coded(spark, d))).withColumn("cb", F.col("cb").cast("long"))


@query("""WITH k AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS cb FROM (SELECT DISTINCT event_type FROM events)),
m AS (SELECT user_id, cb, avg(value) AS loss FROM events JOIN k USING (event_type) WHERE value IS NOT NULL GROUP BY ALL)
SELECT user_id, floor(sum(CASE WHEN cb = 0 THEN 8.0 ELSE 1.0 END * loss) / sum(CASE WHEN cb = 0 THEN 8.0 ELSE 1.0 END) * 1000 + 0.000001) / 1000 AS loss, count(*) AS codebooks FROM m GROUP BY user_id""")
def weighted_loss(spark, d):
    """Measured values, by user and kind of event, which takes the place of a codebook; the kinds are few."""
    per = _losses(spark, d).groupBy("user_id", "cb").agg(F.avg("value").alias("loss"))
    return corpus.weighted_loss(per, "user_id").withColumn("loss", thousandths("loss"))


def thousandths(c: str) -> Column:
    """Cut to thousandths; what sums in another order change stays below the small number."""
    return F.floor(F.col(c) * 1000 + F.lit(1e-6)) / 1000


def _losses(spark, d) -> DataFrame:
    """user_id, cb, value: events with the number of their kind in the order of names."""
    e = spark.read.parquet(f"{d}/events.parquet").where("value IS NOT NULL")
    kinds = spark.read.parquet(f"{d}/events.parquet").select("event_type").distinct()
    return e.join(kinds.withColumn("cb", F.row_number().over(Window.orderBy("event_type")) - 1), "event_type").select("user_id", "cb", "value", "event_id")


@query("SELECT doc_id, lang, CAST((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 50 + 2 AS BIGINT) AS shard FROM documents")
def shard_assign(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    return corpus.sharded(docs, "lang", "doc_id", size=50, offset=2).select("doc_id", "lang", "shard")


@query("WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY sha1('13:' || doc_id), doc_id) AS r, count(*) OVER () AS n FROM documents) SELECT doc_id, CASE WHEN r <= least(128, greatest(1, n // 20)) THEN 'eval' ELSE 'train' END AS part FROM o")
def train_eval_split(spark, d):
    return corpus.train_eval(spark.read.parquet(f"{d}/documents.parquet").select("doc_id"), "doc_id")


@query("SELECT lang AS split, count(*) AS n_rows, count(DISTINCT source) AS speakers, min(coalesce(source, 'unknown') || '_' || lpad(CAST(doc_id AS VARCHAR), 9, '0')) AS first_id, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars FROM documents GROUP BY lang")
def row_defaults(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    named = docs.select("lang", "source", tx.row_id(F.lit(None).cast("string"), F.coalesce("source", F.lit("unknown")), F.col("doc_id")).alias("id"), F.length(F.coalesce("text", F.lit(""))).alias("n"))
    return named.groupBy(F.col("lang").alias("split")).agg(F.count("*").alias("n_rows"), F.countDistinct("source").alias("speakers"), F.min("id").alias("first_id"), F.sum("n").alias("chars"))


@query("SELECT CASE page_id % 4 WHEN 0 THEN 'scripts' WHEN 1 THEN 'stage3' WHEN 2 THEN 'stage4' ELSE 'shards' END AS subset, count(*) AS file_count, CAST(sum(strlen(html)) AS BIGINT) AS total_bytes FROM pages GROUP BY ALL")
def upload_plan(spark, d):
    subset = F.element_at(F.array(*map(F.lit, ("scripts", "stage3", "stage4", "shards"))), (F.col("page_id") % 4 + 1).cast("int"))
    files = spark.read.parquet(f"{d}/pages.parquet").select(subset.alias("subset"), F.octet_length("html").alias("length"))
    return files.groupBy("subset").agg(F.count("*").alias("file_count"), F.sum("length").alias("total_bytes"))


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents")
def row_ordinal(spark, d):
    return ordinal(spark.read.parquet(f"{d}/documents.parquet").select("doc_id"), "doc_id")


@query("SELECT doc_id, '<speech_text> ' || regexp_replace(text, '^" + WS + "+|" + WS + "+$', '', 'g') || chr(10) || '<audio_codes>' AS prompt FROM documents")
def speech_prompts(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", tx.prompt(F.col("text")).alias("prompt"))


@query("SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 20")
def split_limit(spark, d):
    return corpus.first_of_each(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "lang", 20, "doc_id")


@query(BLOCKS_SQL.replace("SELECT response_id, CAST(block AS BIGINT) AS block, CAST(row_number()", "SELECT response_id, CAST(block AS BIGINT) AS block, CASE WHEN block = 0 THEN 'one' ELSE 'two' END AS topic, count(*) AS n_turns FROM (SELECT response_id, block, (row_number()").replace("speaker, text FROM h", "speaker, text FROM h) GROUP BY ALL").replace("AS BIGINT) AS turn", ") AS turn"))
def topics_by_block(spark, d):
    """The last topic goes on for further blocks."""
    parsed = generation.parsed(_responses(spark, d).withColumn("category", F.lit("x")), ("one", "two"))
    return parsed.select("response_id", F.col("block").cast("long").alias("block"), "topic", F.size("turns").cast("long").alias("n_turns"))


@query(rf"WITH {RAW_SQL}, l AS (SELECT conv_id, turn, regexp_replace(regexp_replace('turn ' || turn || ': ' || text || ' ' || text || ' ' || text, '(?s)^[^:]*:', ''), '^{WS}+|{WS}+$', '', 'g') AS r FROM rt) SELECT conv_id, turn, CASE WHEN length(r) > 140 THEN left(r, 137) || '...' ELSE r END AS reason FROM l")
def short_reasons(spark, d):
    long = F.concat(F.lit("turn "), F.col("turn").cast("string"), F.lit(": "), F.concat_ws(" ", "text", "text", "text"))
    return raw_turns(spark, d).select("conv_id", "turn", tx.short_reason(long).alias("reason"))


@query(rf"WITH {TIMED_SQL}, s AS (SELECT conv_id, CASE WHEN conv_id % 4 = 0 AND turn = 1 THEN chr(9) || ' ' ELSE text END AS text, start_ms, CASE WHEN conv_id % 5 = 0 AND turn = 2 THEN start_ms ELSE end_ms END AS end_ms FROM ti) SELECT conv_id, bool_or(regexp_full_match(text, '{WS}*')) AS empty_turn, bool_and(end_ms > start_ms) AS times_hold FROM s GROUP BY conv_id")
def turn_shape(spark, d):
    t = timed(spark, d)
    text = F.when((F.col("conv_id") % 4 == 0) & (F.col("turn") == 1), "\t ").otherwise(F.col("text"))
    end = F.when((F.col("conv_id") % 5 == 0) & (F.col("turn") == 2), F.col("start_ms")).otherwise(F.col("end_ms"))
    nested = t.groupBy("conv_id").agg(F.collect_list(F.struct(text.alias("text"), "start_ms", end.alias("end_ms"))).alias("turns"))
    return nested.select("conv_id", rules.has_empty_turn(F.col("turns")).alias("empty_turn"), rules.times_hold(F.col("turns")).alias("times_hold"))


@query(f"WITH {TIMED_SQL}, s AS (SELECT category, conv_id, (sum(samples) + (count(*) - 1) * 2400) / 24000::DOUBLE AS sec FROM ti GROUP BY ALL) SELECT category, count(*) AS n, round(avg(sec) * count(*) / 20::DOUBLE / 3600, 6) AS hours FROM s GROUP BY category")
def encode_hours(spark, d):
    s = dialogue.mixed_duration(raw_turns(spark, d)).groupBy("category").agg(F.count("*").alias("n"), F.avg(F.col("total_samples") / 24000).alias("mean"))
    return s.select("category", "n", F.round(corpus.wall_hours(F.col("mean"), F.col("n"), 20.0), 6).alias("hours"))


@query("""WITH l AS (SELECT event_type, event_id // 8 AS batch, avg(value) AS loss FROM events WHERE value IS NOT NULL GROUP BY ALL)
SELECT event_type, floor(sum(loss) / greatest(count(*), 1) * 1000 + 0.000001) / 1000 AS loss, count(*) AS batches FROM l GROUP BY event_type""")
def eval_loss(spark, d):
    """Measured values in batches of eight events, their means averaged by kind of event."""
    e = spark.read.parquet(f"{d}/events.parquet").where("value IS NOT NULL")
    per = e.groupBy("event_type", F.floor(F.col("event_id") / 8).alias("batch")).agg(F.avg("value").alias("loss"))
    return corpus.mean_loss(per, "event_type").withColumn("loss", thousandths("loss"))


@query("WITH o AS (SELECT page_id, url, row_number() OVER (ORDER BY page_id) - 1 AS idx FROM pages) SELECT page_id, translate(url, '/.-', '___') AS name, (idx // 500 + 1) * 500 AS mark FROM o")
def progress_marks(spark, d):
    pages = ordinal(spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url"), "page_id")
    return pages.select("page_id", tx.safe_split(F.col("url")).alias("name"), tx.next_mark(F.col("idx"), 500).alias("mark"))


# --- two channels, on the planned conversations with their shift


SEGMENTS_SQL = f"""{SHIFTED_SQL},
said AS (SELECT * FROM st WHERE end_ms > start_ms),
mo AS (SELECT conv_id, mo_ms, sum(u) AS u, sum(a) AS a FROM (
  SELECT conv_id, start_ms AS mo_ms, CASE speaker WHEN 'S0' THEN 1 ELSE 0 END AS u, CASE speaker WHEN 'S1' THEN 1 ELSE 0 END AS a FROM said
  UNION ALL SELECT conv_id, end_ms, CASE speaker WHEN 'S0' THEN -1 ELSE 0 END, CASE speaker WHEN 'S1' THEN -1 ELSE 0 END FROM said
  UNION ALL SELECT conv_id, 0, 0, 0 FROM said) GROUP BY conv_id, mo_ms),
sw AS (SELECT conv_id, mo_ms, sum(u) OVER w > 0 AS u, sum(a) OVER w > 0 AS a, max(mo_ms) OVER (PARTITION BY conv_id) AS fin FROM mo WINDOW w AS (PARTITION BY conv_id ORDER BY mo_ms)),
sx AS (SELECT *, lag(u) OVER w AS pu, lag(a) OVER w AS pa FROM sw WINDOW w AS (PARTITION BY conv_id ORDER BY mo_ms)),
sc AS (SELECT conv_id, mo_ms AS start_ms, lead(mo_ms) OVER (PARTITION BY conv_id ORDER BY mo_ms) AS end_ms, u, a FROM sx WHERE pu IS NULL OR pu <> u OR pa <> a OR mo_ms = fin),
sn AS (SELECT *, CASE WHEN u AND a THEN 'B' WHEN u THEN 'U' WHEN a THEN 'A' ELSE 'N' END AS s FROM sc WHERE end_ms IS NOT NULL),
sl AS (SELECT *, lag(s) OVER w AS p, lag(s, 2) OVER w AS pp, lead(s) OVER w AS n, row_number() OVER w - 1 AS seq FROM sn WINDOW w AS (PARTITION BY conv_id ORDER BY start_ms)),
sg AS (SELECT conv_id, seq, start_ms, end_ms, u AS user, a AS assistant, CASE
  WHEN s = 'N' THEN 'silence'
  WHEN s = 'B' AND (p IS NULL OR p NOT IN ('U', 'A')) THEN 'simultaneous_start'
  WHEN s = 'B' AND n IN ('U', 'A') AND n <> p THEN 'interruption'
  WHEN s = 'B' THEN 'backchannel'
  WHEN p = 'B' AND pp = s THEN 'continue_speaking'
  WHEN p = 'B' THEN 'yield'
  ELSE 'normal_turn' END AS label FROM sl)"""
RESPONSES_SQL = f"""{SEGMENTS_SQL},
us AS (SELECT conv_id, start_ms AS user_start_ms, arg_max(turn, turn) AS user_turn, arg_max(end_ms, turn) AS user_end_ms FROM said WHERE speaker = 'S0' GROUP BY ALL),
re AS (SELECT o.conv_id, o.turn, o.start_ms, user_turn, user_end_ms, o.start_ms - user_end_ms AS latency_ms, coalesce(o.start_ms < user_end_ms, false) AS interrupts
  FROM (SELECT * FROM said WHERE speaker = 'S1') o ASOF LEFT JOIN us ON o.conv_id = us.conv_id AND o.start_ms >= us.user_start_ms)"""


@query(f"WITH {SEGMENTS_SQL} SELECT * FROM sg")
def duplex_segments(spark, d):
    return duplex.segments(_shifted(spark, d))


@query(f"WITH {SEGMENTS_SQL} SELECT label, count(*) AS n, CAST(sum(end_ms - start_ms) AS BIGINT) AS total_ms, count(DISTINCT conv_id) AS conversations FROM sg GROUP BY label")
def duplex_labels(spark, d):
    s = duplex.segments(_shifted(spark, d))
    return s.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("total_ms"), F.countDistinct("conv_id").alias("conversations"))


@query(f"WITH {RESPONSES_SQL} SELECT * FROM re")
def turn_latency(spark, d):
    """Recordings are cut into stretches of 20 seconds, as long ones of a corpus would be."""
    return duplex.responses(_shifted(spark, d), width=20_000)


@query(f"""WITH {RESPONSES_SQL},
fi AS (SELECT conv_id, user_turn, count(*) AS starts, count(*) FILTER (WHERE interrupts) AS early, min(latency_ms) FILTER (WHERE NOT interrupts AND user_turn IS NOT NULL) AS ms FROM re GROUP BY ALL),
an AS (SELECT conv_id, sum(starts) AS assistant_turns, sum(early) AS false_interruptions, count(ms) AS answered, sum(ms) AS latency_ms, min(ms) AS least_ms, max(ms) AS most_ms FROM fi GROUP BY conv_id),
uc AS (SELECT conv_id, count(*) FILTER (WHERE speaker = 'S0') AS user_turns FROM said GROUP BY conv_id),
ut AS (SELECT conv_id, sum(end_ms - start_ms) AS user_ms, sum(CASE WHEN assistant THEN 0 ELSE end_ms - start_ms END) AS silent_ms FROM sg WHERE user GROUP BY conv_id)
SELECT conv_id, user_turns, CAST(coalesce(assistant_turns, 0) AS BIGINT) AS assistant_turns, CAST(coalesce(false_interruptions, 0) AS BIGINT) AS false_interruptions, coalesce(answered, 0) AS answered,
  CAST(coalesce(latency_ms, 0) AS BIGINT) AS latency_ms, coalesce(least_ms, -1) AS least_ms, coalesce(most_ms, -1) AS most_ms, CAST(coalesce(user_ms, 0) AS BIGINT) AS user_ms, CAST(coalesce(silent_ms, 0) AS BIGINT) AS silent_ms
FROM uc LEFT JOIN an USING (conv_id) LEFT JOIN ut USING (conv_id)""")
def turn_taking(spark, d):
    return duplex.turn_taking(_shifted(spark, d)).fillna(-1, ["least_ms", "most_ms"])  # without any answer


def _least_sql(x: str) -> str:
    """The least number of the bucket of x."""
    shift = f"greatest(0, length(bin({x})) - 6)"
    return f"(({x} >> {shift}) << {shift})"


@query(f"""WITH {SEGMENTS_SQL}, ov AS (SELECT label, end_ms - start_ms AS ms FROM sg WHERE user AND assistant),
ra AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY ms) AS r, count(*) OVER (PARTITION BY label) AS n FROM ov)
SELECT label, any_value(n) AS n, {", ".join(f"min({_least_sql('ms')}) FILTER (WHERE r * 1000 >= n * {q}) AS p{q}" for q in (100, 500, 900, 990))}, count(*) FILTER (WHERE ms > 1000) AS failed_to_stop FROM ra GROUP BY label""")
def overlap_quantiles(spark, d):
    """Of how long both speak, by label; the SQL ranks all rows."""
    o = duplex.overlaps(_shifted(spark, d))
    failed = o.groupBy("label").agg(F.sum(F.col("failed_to_stop").cast("long")).alias("failed_to_stop"))
    return quantiles.quantiles(quantiles.sketch(o, "overlap_ms", "label"), 100, 500, 900, 990).join(failed, "label")


RUNS_SQL = f"""{CODES_SQL},
ru AS (SELECT *, sum(CASE WHEN code = pc AND frame = pf + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id, cb ORDER BY frame) AS island
  FROM (SELECT *, lag(code) OVER w AS pc, lag(frame) OVER w AS pf FROM cd WINDOW w AS (PARTITION BY conv_id, cb ORDER BY frame))),
rl AS (SELECT conv_id, cb, min(frame) AS start, min(code) AS code, count(*) AS length FROM ru GROUP BY conv_id, cb, island)"""


def coarse(spark, d) -> DataFrame:
    """Codes in steps of 512, so that frames repeat."""
    return corpus.long_codes(coded(spark, d).withColumn("codes", F.transform("codes", lambda c: F.transform(c, lambda v: F.floor(v / 512).cast("int")))))


@query(f"WITH {RUNS_SQL.replace('AS INTEGER) AS code', 'AS INTEGER) // 512 AS code')} SELECT cb, conv_id, start, code, length FROM rl WHERE length > 1")
def code_runs(spark, d):
    return corpus.code_runs(coarse(spark, d)).where("length > 1").select(F.col("cb").cast("long").alias("cb"), "conv_id", F.col("start").cast("long").alias("start"), "code", "length")


@query(f"""WITH {RUNS_SQL.replace('AS INTEGER) AS code', 'AS INTEGER) // 512 AS code')},
co AS (SELECT cb, code, count(*) AS k FROM cd GROUP BY ALL),
su AS (SELECT cb, CAST(sum(k) AS BIGINT) AS n, count(*) AS distinct_codes, max(k) AS top, sum(k * log2(k)) AS s FROM co GROUP BY cb),
rs AS (SELECT cb, count(*) AS n_runs, max(length) AS longest, CAST(sum(CASE WHEN length > 1 THEN length ELSE 0 END) AS BIGINT) AS in_repeats FROM rl GROUP BY cb)
SELECT cb, n, distinct_codes, top, n_runs, longest, in_repeats, round(log2(n) - s / n, 6) AS entropy FROM su JOIN rs USING (cb)""")
def collapse_report(spark, d):
    return corpus.collapse_report(coarse(spark, d)).withColumns({"cb": F.col("cb").cast("long"), "entropy": F.round("entropy", 6)})


@query(f"""WITH {SHIFTED_SQL}, fr AS (SELECT DISTINCT conv_id, unnest(range(start_ms // 80, (end_ms - 1) // 80 + 1)) * 80 AS t FROM st WHERE end_ms > start_ms AND NOT (conv_id % 2 = 0 AND start_ms // 80 % 3 = 0)),
fi AS (SELECT *, sum(b) OVER (PARTITION BY conv_id ORDER BY t) AS k FROM (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY conv_id ORDER BY t) <= 240 THEN 0 ELSE 1 END AS b FROM fr))
SELECT conv_id, min(t) AS start_ms, max(t) AS last_ms, max(t) + 240 AS endpoint_ms FROM fi GROUP BY conv_id, k""")
def endpoint_guard(spark, d):
    """Speech of both sides as frames of 80 ms, some turns unheard; a turn's frames are one run."""
    t = _shifted(spark, d).where("end_ms > start_ms AND NOT (conv_id % 2 = 0 AND floor(start_ms / 80) % 3 = 0)")
    runs = t.select("conv_id", (F.floor(F.col("start_ms") / 80) * 80).alias("at_ms"), (F.floor((F.col("end_ms") - 1) / 80) * 80).alias("last_ms"), F.lit(True).alias("active"))
    return endpoints.endpoints(runs, last_col="last_ms")


# --- checks of training data


@query(f"WITH {TIMED_SQL}, x AS (SELECT category, ms AS e, CAST(greatest(1, floor(samples / 24000::DOUBLE * 12.5)) AS BIGINT) * 80 AS m FROM ti) SELECT category, count(*) AS n, CAST(sum(e) AS BIGINT) AS expected_ms, CAST(sum(m) AS BIGINT) AS measured_ms, CAST(sum(m - e) AS BIGINT) AS drift_ms, max(abs(m - e)) AS worst_ms FROM x GROUP BY category")
def duration_drift(spark, d):
    return training.duration_drift(timed(spark, d).withColumn("frames", tk.frame_count(F.col("samples"), 24_000)), "category")


@query(f"WITH {RAW_SQL}, x AS (SELECT conv_id, turn, (speaker = 'S0') <> ({DRAW_SQL.format('role')} < 0.5::DOUBLE) AS u FROM rt) SELECT conv_id, turn, CASE WHEN u THEN 'user' ELSE 'assistant' END AS role FROM x")
def role_draws(spark, d):
    return training.roles(raw_turns(spark, d)).select("conv_id", "turn", "role")


@query(f"""WITH {codes_sql(32)}, n AS (SELECT conv_id, min(k) AS frames FROM (SELECT conv_id, cb, count(*) AS k FROM cd GROUP BY ALL) GROUP BY conv_id),
x AS (SELECT CASE WHEN conv_id % 7 = 0 THEN 'failed' WHEN conv_id % 5 = 0 THEN 'empty' WHEN frames > 12 THEN 'too long' ELSE 'kept' END AS verdict, frames FROM n)
SELECT verdict, count(*) AS n, CAST(sum(frames) AS BIGINT) AS frames FROM x GROUP BY verdict""")
def extraction_rejects(spark, d):
    """Every seventh row has lost its codes, every fifth its text."""
    rows = coded(spark, d, 32).withColumn("frames", tk.shortest(F.col("codes")).cast("long"))
    text, codes = F.when(F.col("conv_id") % 5 == 0, " ").otherwise("x"), F.when(F.col("conv_id") % 7 != 0, F.col("codes"))
    verdict = F.coalesce(training.rejected(text, codes, 12), F.lit("kept"))
    return rows.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"), F.sum("frames").alias("frames"))
