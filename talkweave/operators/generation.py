"""Generation of scripts: from responses to accepted rows, resumable.

Requests run in as many partitions as ``concurrency`` says; ids come from row numbers within a bucket; what exists is left out by an anti join.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkweave.config import Bucket, Config, bucket_table
from talkweave.functions import text as tx
from talkweave.operators.ordinal import ordinal_within
from talkweave.operators.rules import judged_scripts
from talkweave.storage import removed, stored

EMPTY_BATCHES = 5


def dry_run(spark: SparkSession, bucket: Bucket, count: int) -> DataFrame:
    """block, response: ``count`` valid blocks of alternating turns, without any model."""
    each = max(4, int((bucket.words_min + bucket.words_max) / 2 / bucket.turn_min))
    turn = lambda i: F.concat(F.lit("["), F.when(i % 2 == 0, "S1").otherwise("S2"), F.lit("] " + " ".join(["word"] * each) + "."))
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(bucket.turn_min - 1)), turn), "\n")
    return spark.range(count).select(F.lit(bucket.name).alias("category"), F.col("id").alias("response_id"), text.alias("response"))


def request_prompts(bucket: Bucket, topics: DataFrame, per_request: int) -> DataFrame:
    """topics: request_id, topic. One prompt per request, with its topics numbered in hash order."""
    rules = (
        f"Please write {per_request} conversations between two people, in everyday English, to be read aloud. Put a line of --- between conversations. Start each turn on a new line with [S1] or [S2], "
        f"taking turns; write only what is said, each turn ending in a full stop, question mark or exclamation mark. A conversation has {bucket.turn_min} to {bucket.turn_max} turns and {bucket.words_min} to {bucket.words_max} words. "
        f"{bucket.description}\nOne conversation on each of these:\n"
    )
    listed = F.array_sort(F.collect_list(F.struct(F.xxhash64("topic").alias("h"), "topic")))
    numbered = F.transform(listed, lambda x, i: F.format_string("%d. %s", i + 1, x["topic"]))
    return topics.groupBy("request_id").agg(F.concat(F.lit(rules), F.array_join(numbered, "\n")).alias("prompt"))


def sampled_topics(requests: DataFrame, topics: list[str] | tuple[str, ...], per_request: int, seed: int) -> DataFrame:
    """Adds topics to request_id: so many different ones, drawn by hash of seed and request; where there are fewer, each place draws from all."""
    listed = F.array(*map(F.lit, topics))
    h = lambda x: F.xxhash64(F.lit(seed), "request_id", x)
    if len(topics) >= per_request:
        order = F.array_sort(F.transform(listed, lambda t: F.struct(h(t).alias("h"), t.alias("topic"))))
        return requests.withColumn("topics", F.slice(order, 1, per_request)["topic"])
    places = F.sequence(F.lit(0), F.lit(per_request - 1))
    return requests.withColumn("topics", F.transform(places, lambda i: F.get(listed, F.pmod(h(i), F.lit(len(topics))).cast("int"))))


def completions(requests: DataFrame, complete: Callable[[str], str], per_minute: float, partitions: int, retries: int = 5, backoff: float = 5.0) -> DataFrame:
    """request_id, prompt to request_id, response through any client. Each of ``partitions`` keeps its share of the rate, and
    tries again after a linearly growing pause."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pause = 60 * partitions / per_minute if per_minute > 0 else 0
        last = 0.0
        for b in batches:
            out = []
            for prompt in b.column(1).to_pylist():
                for attempt in range(retries + 1):
                    time.sleep(max(0.0, last + pause - time.monotonic()))
                    last = time.monotonic()
                    try:
                        out.append(complete(prompt))
                        break
                    except (TimeoutError, ConnectionError) as e:
                        if attempt == retries:
                            raise RuntimeError(f"API failed after retries: {e}") from e
                        time.sleep(backoff * (attempt + 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["request_id", "response"])

    return requests.select(F.col("request_id").cast("long"), "prompt").repartition(partitions, "request_id").mapInArrow(run, "request_id long, response string")


def client_source(config: Config, complete: Callable[[str], str]) -> Callable[[SparkSession, Bucket, int], DataFrame]:
    """A source for ``generate``: requests of ``conversations_per_request`` scripts, each with its own topics, to a client, in ``concurrency`` partitions."""
    g = config.generation
    round_no = 0

    def source(spark: SparkSession, bucket: Bucket, count: int, share: int = 1) -> DataFrame:
        """``share``: how many buckets are asked at once, and share rate and partitions."""
        nonlocal round_no
        round_no += 1
        each = max(1, min(g.conversations_per_request, count))
        requests = sampled_topics(spark.range(-(-count // each)).withColumnRenamed("id", "request_id"), g.topics or tx.TOPICS, each, round_no)
        asked = request_prompts(bucket, requests.select("request_id", F.explode("topics").alias("topic")), each)
        got = completions(asked, complete, g.requests_per_minute / share, max(1, g.concurrency // share), g.api_retries, g.api_retry_backoff_sec)
        # The prompt numbers its topics in hash order, and so does the list here.
        shown = F.transform(F.array_sort(F.transform("topics", lambda t: F.struct(F.xxhash64(t).alias("h"), t.alias("topic")))), lambda x: x["topic"])
        return got.join(requests.select("request_id", shown.alias("topics")), "request_id").select(F.lit(bucket.name).alias("category"), F.col("request_id").alias("response_id"), "response", "topics")

    source.shares_rate = True
    return source


def parsed(responses: DataFrame, topics: tuple[str, ...] = tx.TOPICS) -> DataFrame:
    """category, response_id, response to one script per block, the topic by the block's place: of the response's own topics, if it has
    such a column."""
    own = F.col("topics") if "topics" in responses.columns else F.array(*map(F.lit, topics))
    each = responses.select("category", "response_id", own.alias("topics"), F.posexplode(tx.blocks(F.col("response"))).alias("block", "text"))
    topic = F.element_at("topics", F.least(F.col("block") + 1, F.size("topics")))
    return each.select("category", "response_id", "block", topic.alias("topic"), tx.parse_turns(F.col("text")).alias("turns")).withColumn("estimated_duration_sec", tx.script_estimate(F.col("turns")))


def numbered(accepted: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """Ids by bucket and row number, after the largest number that is taken."""
    rows = ordinal_within(accepted, "category", "response_id", "block", name="row")
    if taken is not None:
        last = taken.groupBy("category").agg((F.max(F.regexp_extract("conversation_id", r"_(\d+)$", 1).cast("long")) + 1).alias("next"))
        rows = rows.join(last, "category", "left").withColumn("row", F.col("row") + F.coalesce("next", F.lit(0))).drop("next")
    return rows.withColumn("conversation_id", tx.conversation_id(F.col("category"), F.col("row")))


def targets(config: Config, limit: int | None) -> dict[str, int]:
    """How many scripts each bucket gets: all, or a limit filled in the order of buckets."""
    left = sum(b.count for b in config.buckets) if limit is None else limit
    out = {}
    for b in config.buckets:
        out[b.name] = max(0, min(b.count, left))
        left -= out[b.name]
    return out


def filled(buckets: DataFrame, order: str, count: str, limit: Column) -> DataFrame:
    """Adds target: a limit filled in the order of buckets, each up to its count. Buckets are few."""
    before = F.coalesce(F.sum(count).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return buckets.withColumn("__limit", limit).withColumn("target", F.greatest(F.lit(0), F.least(F.col(count), F.col("__limit") - before))).drop("__limit")


def rejections(judged: DataFrame) -> str:
    """Short reasons of rejected scripts and how often each was met."""
    reasons = judged.where("reason IS NOT NULL").groupBy(tx.short_reason(F.col("reason")).alias("reason")).agg(F.count("*").alias("n"))
    return reasons.agg(F.collect_list(F.struct("reason", "n")).alias("r")).select(tx.reason_list(F.col("r")).alias("r")).first()["r"]


def reservations(wanted: dict[str, int], done: dict[str, int], most: int | None = None) -> dict[str, int]:
    """What a round asks of each bucket that lacks any: all it lacks, or ``most`` of it. It is reserved: a round keeps no more of a bucket, however much comes back, so buckets never exceed
    their targets."""
    lack = {b: n - done.get(b, 0) for b, n in wanted.items()}
    return {b: min(n, most or n) for b, n in lack.items() if n > 0}


def generate(spark: SparkSession, config: Config, path: str, limit: int | None = None, source: Callable[[SparkSession, Bucket, int], DataFrame] | None = None, most: int | None = None) -> dict[str, int]:
    """Adds accepted scripts below ``path`` until each bucket has its share; running it again adds what is missing only.

    A round asks for all buckets at once what each lacks (at most ``most``), reserves it, and keeps what is accepted of it. A round's scripts are staged beside ``path`` together with the
    manifest (target, completed, failed: rounds of a bucket without a script) and published as one folder by one rename: a run that is killed leaves a whole round or nothing, and the next
    one goes on from what is there. One run at a time may write a path. Five rounds in a row without an accepted script of a bucket end it with an error; each such round is tried
    ``max_retries`` times first. Progress and rejected scripts are told on stderr, and ``path``.manifest has the last manifest. What exists is counted once, then kept by bucket."""
    from talkweave.sources import files

    source = source or dry_run
    wanted = targets(config, limit)
    by_name = {b.name: b for b in config.buckets}
    buckets = bucket_table(spark, config.buckets)
    found = {r["category"]: r["n"] for r in files.read_scripts(spark, path).groupBy("category").agg(F.count("*").alias("n")).join(F.broadcast(buckets), F.col("category") == F.col("name"), "left_semi").collect()}
    done = {b.name: found.get(b.name, 0) for b in config.buckets}
    failed, every = 0, config.generation.progress_every
    told = sum(done.values())
    root = path.rstrip("/")
    removed(spark, f"{root}.staging")
    number = max(files.rounds(spark, root), default=0)
    empty, tries = dict.fromkeys(wanted, 0), dict.fromkeys(wanted, 0)

    def manifest(where: str) -> None:
        row = [(sum(wanted.values()), sum(done.values()), failed)]
        spark.createDataFrame(row, "target long, completed long, failed long").coalesce(1).write.mode("overwrite").json(where)

    while reserved := reservations(wanted, done, most):
        share = {"share": len(reserved)} if getattr(source, "shares_rate", False) else {}
        asked = reduce(DataFrame.unionByName, (parsed(source(spark, by_name[b], n, **share)) for b, n in reserved.items()))
        asked = stored(judged_scripts(asked.withColumn("conversation_id", F.lit("new")), buckets))
        room = F.create_map(*(F.lit(x) for item in reserved.items() for x in item))[F.col("category")]
        good = asked.where("reason IS NULL").drop("conversation_id").withColumn("room", room).where("room IS NOT NULL")
        good = ordinal_within(good, "category", "response_id", "block", name="place").where("place < room").drop("place", "room")
        good = numbered(good, files.read_scripts(spark, path)).select("conversation_id", "category", "topic", "turns", "estimated_duration_sec")
        number += 1
        staged = f"{root}.staging/round={number}"
        good.write.mode("overwrite").json(staged)
        new = {r["category"]: r["n"] for r in spark.read.schema(good.schema).json(staged).groupBy("category").agg(F.count("*").alias("n")).collect()}
        for b, n in reserved.items():
            if (got := new.get(b, 0)) < n:
                print(f"bucket {b}: accepted {got} of {n}; rejected {rejections(asked.where(F.col('category') == b))}", file=sys.stderr)
            if got:
                empty[b] = tries[b] = 0
                done[b] += got
            elif (tries[b] + 1) > config.generation.max_retries:
                empty[b], tries[b], failed = empty[b] + 1, 0, failed + 1
            else:
                tries[b] += 1
        manifest(f"{staged}/_manifest")
        files.publish(spark, staged, f"{root}/round={number}")
        manifest(f"{root}.manifest")
        if every > 0 and sum(done.values()) // every > told // every:
            told = sum(done.values())
            print(f"completed {told} of {sum(wanted.values())}, " + ", ".join(f"{done[b]} in bucket {b}" for b in reserved), file=sys.stderr)
        if stuck := [b for b in wanted if empty[b] >= EMPTY_BATCHES]:
            raise RuntimeError(f"bucket {stuck[0]}: {EMPTY_BATCHES} batches in a row without an accepted script")
    manifest(f"{root}.manifest")
    return done
