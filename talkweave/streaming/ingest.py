"""Resumable ingestion of scripts as a stream: each new file is judged once, accepted scripts are appended by bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave import schemas
from talkweave.operators.rules import judged_scripts


def ingest(spark: SparkSession, source: str, accepted: str, rejected: str, checkpoint: str, buckets: DataFrame) -> None:
    """Handles all files that came since the last run, then ends. Ids that were accepted before, or come twice in a batch,
    are left out. A batch that runs again writes the same folder again, so nothing is doubled."""

    def batch(rows: DataFrame, number: int) -> None:
        rows = rows.persist()
        judged = judged_scripts(rows, buckets)
        good = judged.where("reason IS NULL").drop("reason").dropDuplicates(["conversation_id"])
        before = known(spark, accepted, number)
        if before is not None:
            good = good.join(before, "conversation_id", "left_anti")
        good.write.mode("overwrite").parquet(f"{accepted}/batch={number}")
        judged.where("reason IS NOT NULL").select("conversation_id", "category", "reason").write.mode("overwrite").parquet(f"{rejected}/batch={number}")
        rows.unpersist()

    stream = spark.readStream.schema(schemas.SCRIPT).option("maxFilesPerTrigger", 1000).json(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def known(spark: SparkSession, accepted: str, before: int) -> DataFrame | None:
    from talkweave.sources.files import exists

    if not before or not exists(spark, accepted):
        return None
    return spark.read.option("basePath", accepted).parquet(accepted).where(F.col("batch") < before).select("conversation_id")
