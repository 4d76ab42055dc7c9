"""Functions for SQL texts: register(spark) makes them known to the session, as SQL functions, which Spark puts into the plan like any expression.

Scalars: tw_strip, tw_sanitize, tw_words, tw_space_words, tw_estimate, tw_turn_fault, tw_alternates, tw_has_empty_turn, tw_script_fault, tw_short_reason, tw_conversation_id, tw_speaker_tag,
tw_overlap_ms, tw_turn_samples, tw_samples_ms. Tables: tw_blocks(response) gives block and text; tw_parse_blocks(response) gives block, turn, speaker, text. Both take a column by LATERAL.

    SELECT r.id, b.* FROM responses r, LATERAL tw_parse_blocks(r.response) b

A null argument gives null, or no rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from talkweave.functions import text as tx
from talkweave.functions import timeline as tl
from talkweave.operators import rules

TURNS = "ARRAY<STRUCT<speaker: STRING, text: STRING>>"


def _raw(pattern: str) -> str:
    """A pattern as a raw literal, in the quotes that it doesn't hold."""
    return f'r"{pattern}"' if "'" in pattern else f"r'{pattern}'"


def _replaced(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, {_raw(pattern)}, '{by}')"


def strip(x: str) -> str:
    return _replaced(x, f"(?U)^{tx.SPACE}+|{tx.SPACE}+$")


def ended(x: str) -> str:
    t = strip(x)
    asks = _raw(f"^({tx.INTERROGATIVES.replace(' ', '|')}) ")
    return f"CASE WHEN {t} = '' OR {t} RLIKE {_raw(tx.TERMINAL)} THEN {t} WHEN lower({t}) RLIKE {asks} THEN concat({t}, '?') ELSE concat({t}, '.') END"


def sanitized(x: str) -> str:
    plain = _replaced(_replaced(x, tx.PARENTHETICAL), tx.BRACKETED)
    return ended(_replaced(_replaced(plain, f"(?U){tx.LEADING}"), f"(?U){tx.SPACE}+", " "))


def fault(x: str) -> str:
    return f"CASE WHEN {x} RLIKE {_raw(tx.PARENTHETICAL)} OR {x} RLIKE {_raw(tx.BRACKETED)} THEN '{rules.DIRECTIONS}' WHEN NOT {x} RLIKE {_raw(tx.TERMINAL)} THEN '{rules.PUNCTUATION}' END"


def blocks(x: str) -> str:
    parts = f"filter(transform(split({x}, {_raw(tx.RULE)}), p -> {strip('p')}), p -> p <> '')"
    return f"CASE WHEN size({parts}) > 0 THEN {parts} ELSE array({strip(x)}) END"


def lines(x: str) -> str:
    """speaker and text of the tagged lines of a block."""
    tagged = f"filter(transform(split({x}, {_raw(tx.LINE_ENDS)}), p -> {strip('p')}), p -> p RLIKE {_raw(tx.LINE)})"
    own = f"regexp_extract(p, {_raw(tx.LINE)}, 2)"
    return f"transform({tagged}, p -> named_struct('speaker', CASE WHEN regexp_extract(p, {_raw(tx.LINE)}, 1) = 'S2' THEN 'S1' ELSE 'S0' END, 'text', {sanitized(own)}))"


def _overlap(kind: str, ms: str) -> str:
    of = lambda k: "CAST(least(greatest(floor({} / {}), {}), {}) AS BIGINT)".format(ms, tl.LENGTHS[k][2], *tl.LENGTHS[k][:2])
    first, second, third = tl.KINDS
    return f"CASE {kind} WHEN '{first}' THEN {of(first)} WHEN '{second}' THEN {of(second)} ELSE {of(third)} END"


def functions() -> dict[str, str]:
    """By name what follows it in CREATE TEMPORARY FUNCTION."""
    word, space = _raw(f"(?U){tx.WORD}"), _raw(f"(?U){tx.SPACE}+")
    short = strip("CASE WHEN contains(reason, ':') THEN regexp_replace(reason, r'(?s)^[^:]*:', '') ELSE reason END")
    return {
        "tw_strip": f"(t STRING) RETURNS STRING RETURN {strip('t')}",
        "tw_sanitize": f"(t STRING) RETURNS STRING RETURN {sanitized('t')}",
        "tw_words": f"(t STRING) RETURNS INT RETURN regexp_count(t, {word})",
        "tw_space_words": f"(t STRING) RETURNS INT RETURN size(filter(split(t, {space}), p -> p <> ''))",
        "tw_estimate": "(words DOUBLE, openings DOUBLE) RETURNS DOUBLE RETURN greatest(1.0D, words / 2.6D + openings * 0.4D)",
        "tw_turn_fault": f"(t STRING) RETURNS STRING RETURN {fault('t')}",
        "tw_alternates": f"(turns {TURNS}) RETURNS BOOLEAN RETURN CASE WHEN size(turns) < 2 THEN true ELSE NOT exists(sequence(1, size(turns) - 1), i -> get(turns, i).speaker = get(turns, i - 1).speaker) END",
        "tw_has_empty_turn": f"(turns {TURNS}) RETURNS BOOLEAN RETURN exists(turns, p -> {strip('p.text')} = '')",
        "tw_script_fault": f"(turns {TURNS}) RETURNS STRING RETURN get(filter(transform(turns, p -> {fault('p.text')}), p -> p IS NOT NULL), 0)",
        "tw_short_reason": f"(reason STRING) RETURNS STRING RETURN CASE WHEN length({short}) > 140 THEN concat(substring({short}, 1, 137), '...') ELSE {short} END",
        "tw_conversation_id": "(bucket STRING, idx BIGINT) RETURNS STRING RETURN format_string('%s_%06d', bucket, idx)",
        "tw_speaker_tag": "(speaker STRING) RETURNS STRING RETURN CASE WHEN speaker = 'S0' THEN '[S1]' ELSE '[S2]' END",
        "tw_overlap_ms": f"(kind STRING, ms BIGINT) RETURNS BIGINT RETURN {_overlap('kind', 'ms')}",
        "tw_turn_samples": "(words BIGINT, rate INT) RETURNS BIGINT RETURN CAST(floor(greatest(0.6D, greatest(words, 1) / 2.8D) * rate) AS BIGINT)",
        "tw_samples_ms": "(samples BIGINT, rate INT) RETURNS BIGINT RETURN CAST(rint(samples / rate * 1000) AS BIGINT)",
        "tw_blocks": f"(response STRING) RETURNS TABLE (block BIGINT, text STRING) RETURN SELECT CAST(b.pos AS BIGINT), b.col FROM LATERAL posexplode({blocks('response')}) b",
        "tw_parse_blocks": "(response STRING) RETURNS TABLE (block BIGINT, turn BIGINT, speaker STRING, text STRING) RETURN "
        f"SELECT CAST(b.pos AS BIGINT), CAST(t.pos AS BIGINT), t.col.speaker, t.col.text FROM LATERAL posexplode({blocks('response')}) b, LATERAL posexplode({lines('b.col')}) t",
    }


def register(spark: SparkSession) -> list[str]:
    """Makes all functions known to the session, and gives their names."""
    made = functions()
    for name, text in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{text}")
    return list(made)
