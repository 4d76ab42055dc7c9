"""Column functions on dialogue text. White space, letters and word borders are Unicode's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and words of the script format.
SPACE = r"[\s\x1c-\x1f]"
LINE = r"^\[(S0|S1|S2)\]\s*(.+)$"
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
RULE = r"(?m)^\s*---\s*$"
PARENTHETICAL = r"\([^)]*\)"
BRACKETED = r"\[(?!S[012]\])[^]]+\]"
LEADING = r"^[\s\x1c-\x1f:：\-–—]+"
WORD = r"\b[\w']+\b"
TERMINAL = r"[.!?]$"
INTERROGATIVES = "who what when where why how do does did can could would will should are is was were"
TOPICS = (
    "making evening plans", "fixing a work proposal", "switching careers", "a strange conference story", "planning a weekend trip", "resolving a small misunderstanding",
    "discussing a product launch", "remembering a school incident", "helping a friend make a decision", "debating where to eat",
)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U)^{SPACE}+|{SPACE}+$", "")


def terminal_punctuation(text: Column) -> Column:
    """Ends a text by ? after an interrogative beginning, else by a full stop, unless it ends already."""
    t = strip(text)
    asks = F.lower(t).rlike(f"^({INTERROGATIVES.replace(' ', '|')}) ")
    return F.when((t == "") | t.rlike(TERMINAL), t).when(asks, F.concat(t, F.lit("?"))).otherwise(F.concat(t, F.lit(".")))


def sanitize(text: Column) -> Column:
    """Without stage directions and leading signs, with single spaces and an end."""
    t = F.regexp_replace(F.regexp_replace(text, PARENTHETICAL, ""), BRACKETED, "")
    return terminal_punctuation(F.regexp_replace(F.regexp_replace(t, f"(?U){LEADING}", ""), f"(?U){SPACE}+", " "))


def blocks(response: Column) -> Column:
    """Blocks between lines of ---; the whole text if all are empty."""
    parts = F.filter(F.transform(F.split(response, RULE), strip), lambda x: x != "")
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(strip(response)))


def parse_turns(block: Column) -> Column:
    """array<struct<speaker, text>> of the tagged lines; other lines are passed over. S0 and S1 are the first speaker."""
    lines = F.transform(F.split(block, LINE_ENDS), strip)
    tagged = F.filter(lines, lambda x: x.rlike(LINE))
    speaker = lambda x: F.when(F.regexp_extract(x, LINE, 1) == "S2", "S1").otherwise("S0")
    return F.transform(tagged, lambda x: F.struct(speaker(x).alias("speaker"), sanitize(F.regexp_extract(x, LINE, 2)).alias("text")))


def words(text: Column) -> Column:
    """Words by the word pattern."""
    return F.regexp_count(text, F.lit(f"(?U){WORD}"))


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, f"(?U){SPACE}+"), lambda x: x != "")


def space_words(text: Column) -> Column:
    """Words between white space."""
    return F.size(split_words(text))


def openings(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("("), F.lit("")))


def estimate(word_count: Column, opening_count: Column) -> Column:
    """Seconds that a script takes, from words between spaces and opening brackets."""
    return F.greatest(F.lit(1.0), word_count / F.lit(2.6).cast("double") + opening_count * F.lit(0.4).cast("double"))


def script_estimate(turns: Column) -> Column:
    total = lambda f: F.aggregate(turns, F.lit(0), lambda acc, t: acc + f(t["text"]))
    return estimate(total(space_words), total(openings))


def script_words(turns: Column) -> Column:
    return F.aggregate(turns, F.lit(0), lambda acc, t: acc + words(t["text"]))


def conversation_id(bucket: Column, index: Column) -> Column:
    return F.format_string("%s_%06d", bucket, index)


def tag(speaker: Column) -> Column:
    """The tag that a speaker has in a linear text."""
    return F.when(speaker == "S0", "[S1]").otherwise("[S2]")


def linear(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(tag(t["speaker"]), F.lit(" "), t["text"])), " ")


def short_reason(reason: Column) -> Column:
    """Without the part up to the first colon, cut to 140 characters."""
    r = strip(F.when(reason.contains(":"), F.regexp_replace(reason, r"(?s)^[^:]*:", "")).otherwise(reason))
    return F.when(F.length(r) > 140, F.concat(F.substring(r, 1, 137), F.lit("..."))).otherwise(r)


def reason_list(reasons: Column) -> Column:
    """array<struct<reason, n>> as ``reason xN``, sorted; ``none`` if empty."""
    return F.when(F.size(reasons) == 0, "none").otherwise(F.array_join(F.transform(F.array_sort(reasons), lambda r: F.format_string("%s x%d", r["reason"], r["n"])), ", "))


def next_mark(done: Column, interval: int) -> Column:
    return F.lit(0).cast("bigint") if interval <= 0 else (F.floor(done / interval) + 1) * interval


def safe_split(name: Column) -> Column:
    return F.translate(name, "/.-", "___")


def row_id(id_col: Column, split: Column, index: Column) -> Column:
    return F.coalesce(id_col.cast("string"), F.format_string("%s_%09d", safe_split(split), index))


def prompt(text: Column) -> Column:
    return F.concat(F.lit("<speech_text> "), strip(text), F.lit("\n<audio_codes>"))


def relative_path(path: Column, base: str) -> Column:
    """The path under base, or the path itself where it lies elsewhere."""
    root = base.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(root)), F.substring(path, F.lit(len(root) + 1), F.length(path))).otherwise(path)


def beside(meta_path: Column, value: Column) -> Column:
    """A path given relative to the folder of another file."""
    plain = F.regexp_replace(meta_path, "^[a-z]+:/+", "/")
    return F.when(F.startswith(value, F.lit("/")), value).otherwise(F.concat(F.regexp_replace(plain, "/[^/]*$", "/"), value))
