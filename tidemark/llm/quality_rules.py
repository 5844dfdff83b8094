"""Quality rules: gradient-boosted trees over statistics of a document.

``statistics`` measures whole texts in one pass over Arrow batches. ``fit``
grows small trees (logistic loss, histogram splits) on labelled documents, with
monotonic constraints: more symbols, repeated lines, repeated windows, capitals
or exclamation marks can never raise a score. The trees are flattened into node
arrays, and ``Trees.score`` walks all documents down all trees at once.

The labels used are a bounded sample (``FIT_ROWS`` labelled documents by
smallest hash); a quarter of it is held out, and the score below which a
document is rejected is the largest one, ``REJECT_BELOW`` at most, that keeps
``KEEP_GOOD`` of the held-out good documents.

Statistics, besides the base of the rules (words are ``[^\\x20\\x09-\\x0D]+``):
n_words, word_chars (code points in words), n_symbols (of ``#*$%&|<>``),
n_dup_lines (lines with a word that equal an earlier line), n_repeat_words
(words in 8-word windows that occur twice or more in the text).

Defined results: a null or empty text has zeros throughout and fails the base
rule; other columns stay, except those named like a statistic, which are
replaced; repeated rows are scored alike. Without labels of both classes there
is no model: every document scores 1.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .textcols import U64, flat, limit_batches, mix, per_row, powers, slices, span_hashes, words

WINDOW = 8
FIT_ROWS = 20_000
HELD_OUT = 4
REJECT_BELOW = 0.5
KEEP_GOOD = 0.998

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "capital_share", "bang_share",
            "digit_share", "line_words", "distinct_share", "stopped_lines", "stop_share")
#: -1: the score never rises with the feature.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "capital_share": -1, "bang_share": -1}

_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_LETTER = _CAPITAL.copy()
_LETTER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


def measure(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(base statistics, features) of a batch of texts, a row for each text."""
    n = len(off) - 1
    starts, ends, first = words(raw, off)
    solid = np.zeros(len(raw) + 1, np.int8)
    np.add.at(solid, starts, 1)
    np.add.at(solid, ends, -1)
    solid = np.cumsum(solid[:-1]).astype(bool)
    n_words = np.diff(first)
    doc = np.repeat(np.arange(n), n_words)
    in_words = per_row(solid & ((raw & 0xC0) != 0x80), off)
    symbols = per_row(SYMBOLS[raw], off)
    hashes = span_hashes(raw, starts, ends)

    # Lines: cut at newlines and between texts; those without a word don't count.
    newline = np.flatnonzero(raw == 10)
    opens = np.union1d(np.r_[newline + 1, off[:-1]], off[-1:])
    opens = opens[opens < len(raw)] if len(raw) else opens[:0]
    closes = np.minimum(np.r_[opens[1:], len(raw)], len(raw))
    ended = (closes > opens) & (raw[np.maximum(closes - 1, 0)] == 10) if len(opens) else np.zeros(0, bool)
    closes = closes - ended
    line_words = np.searchsorted(starts, closes) - np.searchsorted(starts, opens)
    real = line_words > 0
    opens, closes = opens[real], closes[real]
    line_doc = np.searchsorted(off, opens, side="right") - 1
    codes = _exact_codes(raw, opens, closes)
    lines = np.bincount(line_doc, minlength=n)
    pairs = np.unique(line_doc * (int(codes.max(initial=0)) + 1) + codes)
    distinct_lines = np.bincount(pairs // (int(codes.max(initial=0)) + 1), minlength=n)
    dup_lines = lines - distinct_lines
    stopped = np.bincount(line_doc, weights=_STOP[raw[closes - 1]] if len(closes) else None, minlength=n)

    # Windows of eight words: equal ones in a text have equal keys.
    repeated = np.zeros(len(starts) + 1, np.int64)
    if len(starts) >= WINDOW:
        factor = powers(WINDOW, 0xD6E8FEB86659FD93)
        window = np.zeros(len(starts) - WINDOW + 1, U64)
        for i in range(WINDOW):
            window += hashes[i:i + len(window)] * factor[i]
        whole = doc[WINDOW - 1:] == doc[:len(window)]
        at = np.flatnonzero(whole)
        key = mix(window[at] + mix(doc[at].astype(U64) + U64(1)))
        ordered = np.sort(key)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            hit = at[twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key]
            np.add.at(repeated, hit, 1)
            np.add.at(repeated, hit + WINDOW, -1)
    repeat_words = per_row(np.cumsum(repeated[:-1]) > 0, first)

    key = np.unique((doc.astype(U64) << U64(40)) | (hashes >> U64(24)))
    distinct = np.bincount((key >> U64(40)).astype(np.int64), minlength=n)
    base = np.stack([n_words, in_words, symbols, dup_lines, repeat_words], axis=1).astype(np.int64)

    def share(a, b):
        return np.asarray(a, float) / np.maximum(b, 1)

    features = np.stack([
        np.log1p(n_words), share(in_words, n_words), share(symbols, n_words), share(dup_lines, lines),
        share(repeat_words, n_words), share(per_row(_CAPITAL[raw], off), per_row(_LETTER[raw], off)),
        share(per_row(raw == ord("!"), off), n_words), share(per_row(_DIGIT[raw], off), np.diff(off)),
        share(n_words, lines), share(distinct, n_words), share(stopped, lines), share(per_row(_STOP[raw], off), n_words),
    ], axis=1)
    return base, features


def _exact_codes(raw: np.ndarray, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
    """Equal numbers for equal byte spans, compared byte by byte."""
    if not len(opens):
        return np.zeros(0, np.int64)
    edges = np.empty(2 * len(opens) + 1, np.int64)
    edges[0:-1:2], edges[1::2], edges[-1] = opens, closes, len(raw)
    spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [
        None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(raw))])
    lines = spans.take(pa.array(np.arange(0, len(edges) - 1, 2)))
    return lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


@dataclass
class Trees:
    """All trees' nodes in flat arrays; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float
    cut: float = REJECT_BELOW

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of a good document, one for each row of features."""
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.bias + self.value[at].sum(axis=1))))


def constant() -> Trees:
    none = np.zeros(0)
    return Trees(none.astype(int), none, none.astype(int), none.astype(int), none, none.astype(int), 0, 50.0)


def grow(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3,
         bins: int = 48, smooth: float = 5.0, least: float = 3.0) -> Trees:
    """Boosted trees; splits are chosen on histograms of quantile bins."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(m)], axis=1)
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(p / (1 - p)))
    raw = np.full(n, bias)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        i = len(feature)
        feature.append(0), threshold.append(np.inf), left.append(i), right.append(i), value.append(0.0)
        return i

    for _ in range(trees):
        prob = 1 / (1 + np.exp(-raw))
        g, h = y - prob, prob * (1 - prob)
        roots.append(node())
        grown = [(roots[-1], np.arange(n), -np.inf, np.inf, 0)]
        while grown:
            at, rows, low, high, level = grown.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            here = float(np.clip(gs / (hs + smooth), low, high))
            value[at] = rate * here
            best = (1e-6, None)
            for j in range(m) if level < depth else ():
                k = len(edges[j]) + 1
                gl = np.cumsum(np.bincount(binned[rows, j], weights=g[rows], minlength=k))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, j], weights=h[rows], minlength=k))[:-1]
                if not len(gl):
                    continue
                vl = np.clip(gl / (hl + smooth), low, high)
                vr = np.clip((gs - gl) / (hs - hl + smooth), low, high)
                gain = gl * vl - 0.5 * (hl + smooth) * vl**2 + (gs - gl) * vr - 0.5 * (hs - hl + smooth) * vr**2
                gain -= gs * here - 0.5 * (hs + smooth) * here**2
                gain[(hl < least) | (hs - hl < least) | (monotone[j] * (vr - vl) < 0)] = -np.inf
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], (j, i, vl[i], vr[i]))
            if best[1] is None:
                raw[rows] += value[at]
                continue
            j, i, vl, vr = best[1]
            feature[at], threshold[at] = j, float(edges[j][i])
            left[at], right[at] = node(), node()
            goes = binned[rows, j] <= i
            middle = (vl + vr) / 2
            lows, highs = [low, low], [high, high]
            if monotone[j] < 0:
                lows[0], highs[1] = middle, middle
            elif monotone[j] > 0:
                highs[0], lows[1] = middle, middle
            grown += [(left[at], rows[goes], lows[0], highs[0], level + 1),
                      (right[at], rows[~goes], lows[1], highs[1], level + 1)]
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value),
                 np.array(roots), depth, bias)


def statistics(df: DataFrame, text: str = "text", trees: Trees | None = None, features: bool = False) -> DataFrame:
    """``df`` with the base statistics, and with a model also quality_score."""
    spark = df.sparkSession
    limit_batches(spark)
    added = [T.StructField(c, T.LongType()) for c in BASE]
    if trees is not None:
        added.append(T.StructField("quality_score", T.DoubleType()))
    if features:
        added.append(T.StructField("features", T.ArrayType(T.DoubleType())))
    taken = {f.name for f in added}
    kept = [f for f in df.schema.fields if f.name.lower() not in taken]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                base, x = measure(*flat(part.column(text)))
                new = [pa.array(base[:, i]) for i in range(len(BASE))]
                if trees is not None:
                    new.append(pa.array(trees.score(x)))
                if features:
                    new.append(pa.array(x.tolist(), pa.list_(pa.float64())))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + new, names + [f.name for f in added])

    return df.mapInArrow(run, T.StructType(kept + added))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def labelled(docs: DataFrame, labels: DataFrame, column: str, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents by smallest
    hash; of contradicting labels the smaller one counts."""
    chosen = (labels.where(f"doc_id is not null and {column} is not null").groupBy("doc_id")
              .agg(F.min(column).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").limit(2 * rows)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Trees:
    """Trees from the labelled sample; its features (not texts) come to the driver."""
    sample = statistics(labelled(docs, labels, "quality", rows), features=True).select("doc_id", "label", "features")
    got = sorted((r.doc_id, r.label, list(r.features)) for r in sample.collect())
    if len({r[1] for r in got}) < 2:
        return constant()
    x, y = np.array([r[2] for r in got]), np.array([float(r[1] > 0) for r in got])
    held = mix(np.array([r[0] for r in got]).astype(np.int64).astype(U64)) % U64(HELD_OUT) == 0
    monotone = np.array([MONOTONE.get(f, 0) for f in FEATURES])
    if len(set(y[~held])) < 2:
        return grow(x, y, monotone)
    trees = grow(x[~held], y[~held], monotone)
    good = trees.score(x[held & (y > 0)])
    if len(good):
        trees.cut = float(min(REJECT_BELOW, np.quantile(good, 1 - KEEP_GOOD)))
    return trees


def judge(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with statistics, quality_score, base_failed and kept."""
    found = statistics(docs, trees=trees)
    taken = {"base_failed", "kept"}
    found = found.select(*[c for c in found.columns if c.lower() not in taken])
    return found.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality_score") >= trees.cut))
