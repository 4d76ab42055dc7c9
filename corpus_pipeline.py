"""The training-data pipeline: five stages over ``documents``, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. n_chars follows
the text where a stage changes it.

For all stages: an empty table gives an empty one; further columns, whatever their names, pass unchanged (but for packing, which has columns of its
own); texts are read whole, however long; rows without an id (null) and rows that repeat an id are rows like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm import langid, near_dedup, packing, pii, suffix_dedup
from talkweave.llm.common import stored, table

#: Near duplicates: words in a shingle, and similarity in hundredths.
SHINGLE, PERCENT = 5, 80


def _counted(docs: DataFrame, n_chars: str = "n_chars") -> DataFrame:
    return docs.withColumn(n_chars, F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long"))) if n_chars in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that can be told go: a null or empty text, and one without letters. A null language is filled in; where no document has
    one, texts with letters stay. Rows that repeat are told alike."""
    return langid.keep_identified(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the least id (a null id last; ties by a hash of id and text). Texts without words (null too) are
    duplicates of nothing and all stay; of rows that repeat id and text one stays."""
    return near_dedup.keep_one(docs, SHINGLE, PERCENT)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes and more that occur more than once are taken out, at all their places; a character stays whole. All rows stay, a text of which
    nothing is left as an empty one; a null text stays null, with n_chars 0. Rows that repeat lose what is long enough."""
    return _counted(suffix_dedup.remove_repeats(docs))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked. All rows stay; a null text stays null, with n_chars 0; rows that repeat are masked alike."""
    return _counted(pii.mask_documents(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences; a row for each piece. A null or empty text has one piece, its end mark; rows that repeat are packed each."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: No stage but the first can be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
