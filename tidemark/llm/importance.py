"""Quality classifier by importance resampling.

Two generative models over hashed n-grams (words and pairs of words, lower
case, one shared table of ``BUCKETS`` counts): one of the target text, one of
all raw text. A document's log weight is the log ratio of its likelihoods, the
sum over its n-grams of log p_target - log p_raw. Adding Gumbel noise (from a
hash of doc_id, so reruns agree) and taking the k largest keys is sampling k
documents without replacement in proportion to their weights.

The raw model counts every document in one pass; each task sends one partial
table, so what moves is bounded by tasks times buckets. The target model counts
the documents labelled good (quality 1, not toxic) of a bounded sample of
``FIT_ROWS`` labels by smallest hash.

How many documents stay follows from the labels: the share of labels of quality 0,
less ``MARGIN`` standard errors of that share, is what the sample may leave out; k
is the rest of the corpus, rounded up. Another k can be given. The k-th largest key
is found exactly from histograms of the stored keys, level by level, without
sorting documents.

Defined results: a null or empty text has log weight 0 and only its noise; a
null doc_id takes its noise from the text's hash; rows with equal doc_id and text
share their key, and all documents with the k-th key are taken; a k of 0 takes
none. Without target documents every weight is 0 and every document stays. Input columns named like
an output are replaced.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import scratch_path
from .textcols import U64, flat, limit_batches, lower_ascii, mix, slices, span_hashes, words

BUCKETS = 1 << 14
FIT_ROWS = 20_000
#: Standard errors of the share of bad labels that k leaves on the safe side.
MARGIN = 2.0
#: Keys are compared as whole multiples of this.
KEY_STEP = 2.0**-20
_KEY_BITS = 48
OUTPUTS = ("log_weight", "key", "kept")


@dataclass
class Model:
    #: log p_target - log p_raw of each bucket
    ratio: np.ndarray
    #: Share of the documents that the sample takes.
    share: float = 1.0


def buckets(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every n-gram and the text it is in."""
    raw = lower_ascii(raw)
    starts, ends, first = words(raw, off)
    h = span_hashes(raw, starts, ends)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    inside = doc[1:] == doc[:-1]
    pairs = mix(h[:-1] * U64(0x9FB21C651E98DF25) + h[1:])[inside]
    return (np.r_[h, pairs] % U64(BUCKETS)).astype(np.int64), np.r_[doc, doc[1:][inside]]


def gumbel(key: np.ndarray) -> np.ndarray:
    """Gumbel noise from 64-bit keys."""
    u = ((mix(key) >> U64(12)).astype(float) + 0.5) / 2.0**52
    return -np.log(-np.log(u))


def _partial_counts(df: DataFrame) -> DataFrame:
    """(bucket, raw, target) sums of each task; ``df`` has text and is_target."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                found, doc = buckets(*flat(part.column("text")))
                raw += np.bincount(found, minlength=BUCKETS)
                flags = part.column("is_target").to_numpy(zero_copy_only=False).astype(bool)
                if flags.any():
                    target += np.bincount(found[flags[doc]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])],
                                             ["bucket", "raw", "target"])

    return df.mapInArrow(run, "bucket long, raw long, target long")


def sampled_labels(labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(target_id, good, bad) of at most ``rows`` labelled documents by smallest
    hash; one bad or toxic label of a document outweighs good ones."""
    chosen = (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("target_id"))
              .agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
              .orderBy(F.xxhash64("target_id"), "target_id").limit(rows))
    return chosen.select("target_id", F.expr("quality > 0 and toxic <= 0").alias("good"), F.expr("quality <= 0").alias("bad"))


def share_kept(labelled: int, bad: int) -> float:
    """The share of all documents that stays, by the labels."""
    if not labelled:
        return 1.0
    p = bad / labelled
    return 1 - max(0.0, p - MARGIN * math.sqrt(p * (1 - p) / labelled))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Both models, and the share of documents that stays."""
    limit_batches(docs.sparkSession)
    path = scratch_path(docs.sparkSession, "label-sample")
    sampled_labels(labels, rows).write.parquet(path)
    chosen = docs.sparkSession.read.parquet(path)
    good = F.broadcast(chosen.where("good").select("target_id"))  # ``rows`` ids at most
    flagged = docs.select("doc_id", "text").join(good, F.col("doc_id") == F.col("target_id"), "left")
    counted = _partial_counts(flagged.select("text", F.col("target_id").isNotNull().alias("is_target")))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    if not target.sum():
        return Model(np.zeros(BUCKETS))
    n = chosen.agg(F.count("*").alias("all"), F.count_if("bad").alias("bad")).first()
    ratio = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    return Model(ratio, share_kept(n["all"], n.bad))


def score(df: DataFrame, model: Model) -> DataFrame:
    """``df`` (doc_id, text, ...) with log_weight and key (log weight plus Gumbel noise)."""
    limit_batches(df.sparkSession)
    added = [T.StructField("log_weight", T.DoubleType()), T.StructField("key", T.DoubleType())]
    kept = [f for f in df.schema.fields if f.name.lower() not in ("log_weight", "key")]
    names = [f.name for f in kept]
    ratio = model.ratio

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw, off = flat(part.column("text"))
                found, doc = buckets(raw, off)
                weight = np.bincount(doc, weights=ratio[found], minlength=part.num_rows)
                ids = part.column("doc_id")
                noise = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).astype(U64)
                if ids.null_count:
                    whole = span_hashes(raw, off[:-1], np.maximum(off[1:], off[:-1])) if len(raw) else noise
                    noise = np.where(ids.is_null().to_numpy(zero_copy_only=False), whole, noise)
                key = np.floor((weight + gumbel(noise)) / KEY_STEP) * KEY_STEP
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [pa.array(weight), pa.array(key)],
                                                 names + ["log_weight", "key"])

    return df.mapInArrow(run, T.StructType(kept + added))


def kth_largest(keys: DataFrame, k: int, column: str = "key") -> float:
    """The k-th largest key, exactly: histograms of 12 bits, of which only the
    bucket that holds the k-th key is refined. One row comes to the driver each time."""
    top = (1 << (_KEY_BITS - 1)) - 1
    steps = F.greatest(F.least(F.col(column) / F.lit(KEY_STEP), F.lit(float(top))), F.lit(float(-top)))
    fixed = keys.where(F.col(column).isNotNull()).select((steps.cast("long") + F.lit(top + 1)).alias("v"))
    if k < 1:
        return np.inf
    prefix, rest, left = 0, k, _KEY_BITS
    for _ in range(_KEY_BITS // 12):
        above, left = left, left - 12
        hist = (fixed.where(F.shiftright("v", above) == prefix).groupBy(F.shiftright("v", left).alias("b"))
                .agg(F.count("*").alias("n")))
        cum = hist.withColumn("cum", F.sum("n").over(Window.orderBy(F.desc("b"))))  # 4096 buckets at most
        row = cum.where(F.col("cum") >= rest).orderBy(F.desc("b")).first()
        if row is None:
            return -np.inf
        prefix, rest = row.b, rest - (row.cum - row.n)
    return (prefix - top - 1) * KEY_STEP


def top_k(scored: DataFrame, model: Model, k: int | None = None) -> DataFrame:
    """``scored`` rows (a stored table with key) with kept: whether the key is one
    of the k largest, by default the model's share of all rows."""
    keys = scored.select("key")
    cut = kth_largest(keys, math.ceil(model.share * keys.count()) if k is None else k)
    scored = scored.select(*[c for c in scored.columns if c.lower() != "kept"])
    return scored.withColumn("kept", F.col("key") >= F.lit(float(cut)))


def resample(docs: DataFrame, model: Model, k: int | None = None) -> DataFrame:
    """``docs`` scored, with kept: the Gumbel top-k. Scores are written once, so
    that the cut and the result read the same keys."""
    path = scratch_path(docs.sparkSession, "importance")
    score(docs, model).write.parquet(path)
    return top_k(docs.sparkSession.read.parquet(path), model, k)


def weigh(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, log_weight, key) of each row of ``docs``, without the texts."""
    return score(docs.select("doc_id", "text"), model).select("doc_id", "log_weight", "key")
