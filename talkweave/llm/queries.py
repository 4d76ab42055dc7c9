"""The training-data queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from talkweave.llm import hard_negatives, line_dedup, near_dedup, suffix_dedup, topk, warc
from talkweave.llm.bpe import op10_bpe
from talkweave.llm.html_text import op2_html
from talkweave.llm.langid import op8_langid
from talkweave.llm.media import op1_media
from talkweave.llm.near_dedup import op4_near_dedup
from talkweave.llm.packing import op6_packing
from talkweave.llm.pii import op7_pii
from talkweave.llm.resample import op11_resample
from talkweave.llm.suffix_dedup import op5_suffix_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_media, op2_html, topk.op3_topk, op4_near_dedup, op5_suffix_dedup, op6_packing, op7_pii, op8_langid, warc.op9_warc, op10_bpe, op11_resample, hard_negatives.op12_hard_negatives, line_dedup.op13_line_dedup)}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_topk": topk.ORACLE_SQL,
        "op4_near_dedup": near_dedup.ORACLE_SQL,
        "op5_suffix_dedup": suffix_dedup.ORACLE_SQL,
        "op9_warc": warc.ORACLE_SQL,
        "op12_hard_negatives": hard_negatives.ORACLE_SQL,
        "op13_line_dedup": line_dedup.ORACLE_SQL,
    }
