"""Language identification by mixture inference.

Training: letter trigrams of a bounded sample of labelled documents are counted per language in hash buckets,
giving smoothed log probabilities. Prediction: a document's trigrams are a mixture of languages. Expectation-maximisation
estimates its proportions from the trigrams' likelihoods; then, adding languages by proportion, the set is chosen whose
likelihood, less a penalty for each language, is greatest. The predicted language is the largest of the set.

The sample is about ``sample_docs`` documents of each language, a documented bound: whole texts, chosen by a hash of id and text. All values of the language column are learned. The model
keeps only the counts that a language has, by bucket, so it takes what the sample's different trigrams take; every document is predicted from its whole text.

Results for edge cases: a null text, or one without letters, is ``und`` with score 0; so are all where no labelled document
exists. Words of fewer letters than three count with their borders. Languages are tried in alphabetical order on
ties. A text of any length is read whole. Rows are independent, so rows that repeat an id or text are predicted alike; an empty table gives an
empty one. Other columns are ignored by predict(), and kept by keep_identified(), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm.common import bounded_batches, free_names, stored, table, with_column

BUCKETS = 1 << 15
#: Documents of each language that are learned from, about.
SAMPLE_DOCS = 2000
#: Up to so many labels, a few megabytes, are sent to all tasks with the share of each; of more, texts are dealt to SALTS tasks a label.
FEW_LABELS, SALTS = 50_000, 64
#: Languages that a task counts at once before it sends its counts on.
AT_ONCE = 64
#: Steps of expectation-maximisation, and the change in proportions at which it ends.
STEPS, CLOSE = 15, 1e-3
#: What each further language must add to the log likelihood, times the log of the number of trigrams.
PENALTY = 6.0
#: Languages of a smaller share are not tried.
SMALL = 0.02
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """True for each code point that is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the letter trigrams; runs of other characters are one border."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[c]
    if not letter.any():
        return np.empty(0, np.int64)
    c = np.where(letter, c, 32)
    c = np.concatenate(([32], c[(c != 32) | np.concatenate(([True], c[:-1] != 32))], [32])).astype(np.uint32)
    h = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA6B) + c[2:] * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(15)
    return ((h * np.uint32(0x2C1B3C6D)) >> np.uint32(17)).astype(np.int64)


class Model:
    """Languages, and how often each bucket occurs in each, by bucket; the probability of a bucket is its count and a little more, over the language's sum of such."""

    def __init__(self, langs: list[str], lang: np.ndarray, bucket: np.ndarray, n: np.ndarray):
        self.langs = langs
        order = np.argsort(bucket, kind="stable")
        self.lang, self.n = lang[order].astype(np.int32), n[order].astype(np.float64)
        self.starts = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
        self.extra = 0.5 * (np.diff(self.starts) > 0) + 0.01
        self.total = np.bincount(lang, n, len(langs)) + self.extra.sum()

    def logp(self, buckets: np.ndarray) -> np.ndarray:
        """Languages by buckets."""
        first, size = self.starts[buckets], self.starts[buckets + 1] - self.starts[buckets]
        at = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        p = np.repeat(self.extra[buckets][None, :], len(self.langs), axis=0)
        p[self.lang[at], np.repeat(np.arange(len(buckets)), size)] += self.n[at]
        return np.log(p / self.total[:, None])


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, id_col: str | None = None) -> Model:
    """The counts that reach the driver are those of the sample's different trigrams in each language. ``id_col`` tells copies of a text apart in the sample."""
    spark = df.sparkSession
    bounded_batches(spark)
    own = F.col(id_col).cast("string") if id_col else F.lit(None).cast("string")
    known = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), own.alias("own")).where("lang IS NOT NULL AND text IS NOT NULL")
    shares = stored(known.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(sample_docs)) / F.count("*")).alias("share")))
    h = F.xxhash64("own", "text")
    if shares.count() <= FEW_LABELS:
        told_share = known.join(F.broadcast(shares), "lang")
    else:  # texts are shuffled then, those of one label to SALTS tasks
        salted = shares.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        told_share = known.withColumn("salt", F.pmod(h, F.lit(SALTS)).cast("int")).join(salted, ["lang", "salt"])
    sample = told_share.where(F.pmod(h, F.lit(1 << 20)) < F.col("share") * (1 << 20)).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, n in total.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "bucket", "n"])
            total.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[lang] = total.get(lang, 0) + np.bincount(trigrams(text), minlength=BUCKETS)
                if len(total) > AT_ONCE:
                    yield from counted()
        yield from counted()

    found = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(found["lang"].to_pylist()))
    row = {k: i for i, k in enumerate(langs)}
    lang = np.fromiter((row[k] for k in found["lang"].to_pylist()), np.int64, found.num_rows)
    return Model(langs, lang, found["bucket"].to_numpy(), found["n"].to_numpy())


def mixture(n: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """Proportions of the languages of a document; n: count of each trigram, logp: languages by trigrams. Languages
    outside the chosen set have 0."""
    p = np.exp(logp - logp.max(0))
    k, total = len(p), n.sum()

    def fitted(rows: np.ndarray) -> tuple[np.ndarray, float]:
        share = np.full(len(rows), 1 / len(rows))
        if len(rows) == 1:
            return share, float(n @ np.log(p[rows[0]]))
        q = p[rows]
        for _ in range(STEPS):
            new = share * (q @ (n / (share @ q))) / total
            done = np.abs(new - share).max() < CLOSE
            share = new
            if done:
                break
        return share, float(n @ np.log(share @ q))

    share, _ = fitted(np.arange(k))
    order = np.lexsort((np.arange(k), -share))
    chosen, chosen_share, most = order[:1], np.ones(1), fitted(order[:1])[1]
    price = PENALTY * np.log(total + 1)
    for size in range(2, k + 1):
        if share[order[size - 1]] < SMALL:
            break
        part, likelihood = fitted(order[:size])
        if likelihood - price * (size - 1) > most:
            chosen, chosen_share, most = order[:size], part, likelihood - price * (size - 1)
    out = np.zeros(k)
    out[chosen] = chosen_share
    return out


def told(model: Model, text: str | None) -> np.ndarray | None:
    """The proportions of the languages in a text; None if it can't be told."""
    grams = trigrams(text)
    if not len(grams) or not model.langs:
        return None
    n = np.bincount(grams, minlength=BUCKETS)
    at = np.flatnonzero(n)
    return mixture(n[at].astype(np.float64), model.logp(at))


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, languages array<struct<lang, share>>) for every row."""
    spark = df.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    part = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = sent.value.langs
        for b in batches:
            best, score, mixed = [], [], []
            for text in b.column(1).to_pylist():
                share = told(sent.value, text)
                if share is None:
                    best.append(UNKNOWN), score.append(0.0), mixed.append([])
                    continue
                top = int(share.argmax())
                best.append(langs[top]), score.append(float(min(1.0, share[top])))
                mixed.append([{"lang": langs[i], "share": float(share[i])} for i in np.argsort(-share, kind="stable") if share[i] > 0])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(mixed, part)], ["id", "lang_pred", "score", "languages"])

    kind = df.select(id_col).schema[0].dataType.simpleString()
    return df.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, lang_pred string, score double, languages array<struct<lang: string, share: double>>").withColumnRenamed("id", id_col)


def keep_identified(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose language can be told, with all columns; a missing language is filled in. The model is trained on the
    rows that have one. Where no row has one, nothing can be told, and rows stay if their text has letters."""
    model = train(df, text_col, lang_col)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def best(texts: list[str | None]) -> list[str | None]:
        out: list[str | None] = []
        for text in texts:
            share = told(sent.value, text)
            nothing = UNKNOWN if sent.value.langs or not len(trigrams(text)) else None
            out.append(nothing if share is None else sent.value.langs[int(share.argmax())])
        return out

    (name,) = free_names(df, "lang")
    known = with_column(df, name, "string", pa.string(), (text_col,), best).where(F.coalesce(F.col(name), F.lit("")) != UNKNOWN)
    return known.withColumn(lang_col, F.coalesce(F.col(lang_col), name)).select(*df.columns)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()), id_col="doc_id")
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
