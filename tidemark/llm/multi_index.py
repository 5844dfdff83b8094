"""Nearest neighbours by multi-index hashing of learned binary codes.

Vectors are centred, turned to their principal axes and then rotated so that
their signs lose little (iterative quantization); the signs are a code of up to
64 bits. A code is cut into four substrings, each with an index of its own. If
two codes differ in at most r bits, one of their substrings differs in at most
r // 4 (pigeonhole), so probing all substring values within that distance
retrieves every code within the Hamming radius r. What is retrieved is reranked
by the Euclidean distance of the original vectors in double precision.

Rows are dealt by a hash of vec_id into shards of at most about ``SHARD_ROWS``
rows; every query is sent to every shard and streamed past the shard's index,
which is all that a task holds. Shards don't depend on the vectors, so equal or
crowded vectors meet in no particular task. Each shard returns its nearest, and
a window over these keeps the nearest of all.

The rotation and the radius are learned on ``FIT_ROWS`` rows by smallest hash: the
radius is the one that holds ``COVER`` of the true neighbours in that sample; all
rows are indexed. A query that finds fewer than it needs in a shard widens its
radius there until it has enough or has seen the whole shard.

Defined results: vectors that are null, zero, of another length than the most
common one, or hold null or non-finite components take no part, neither do rows
with a null vec_id; rows that share a vec_id count once (the smallest vector).
Equal distances go to the smaller vec_id. Extra columns are ignored; an empty
table has no result.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .textcols import limit_batches

FIT_ROWS = 20_000
FIT_QUERIES = 256
COVER = 0.985
ROUNDS = 30
PARTS = 4
SHARD_ROWS = 1 << 17
SMALL_SHARD = 1 << 12
_BITS = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


@dataclass
class Codes:
    mean: np.ndarray
    axes: np.ndarray  # components by bits
    radius: int = 0

    @property
    def bits(self) -> int:
        return self.axes.shape[1]

    def encode(self, x: np.ndarray) -> np.ndarray:
        """The four substrings of each row's code, as a row of 16-bit numbers."""
        signs = (x - self.mean) @ self.axes > 0
        width = -(-self.bits // PARTS)
        out = np.zeros((len(x), PARTS), np.uint16)
        for j in range(self.bits):
            out[:, j // width] |= signs[:, j].astype(np.uint16) << np.uint16(j % width)
        return out


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _BITS[a ^ b].sum(axis=-1, dtype=np.int64)


def learn(x: np.ndarray, k: int) -> Codes:
    """The rotation of a sample, and the radius that covers its neighbours."""
    mean = x.mean(axis=0)
    c = x - mean
    bits = min(16 * PARTS, x.shape[1])
    _, axes = np.linalg.eigh(c.T @ c)
    v = c @ axes[:, ::-1][:, :bits]
    r = np.linalg.qr(np.random.default_rng(7).normal(size=(bits, bits)))[0]
    for _ in range(ROUNDS):
        u, _, w = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
        r = (u @ w).T
    codes = Codes(mean, axes[:, ::-1][:, :bits] @ r)
    own = codes.encode(x)
    far = []
    for i in range(0, len(x), max(1, len(x) // FIT_QUERIES)):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[:min(k, len(x) - 1)]
        far.append(hamming(own[near], own[i]))
    if far and len(far[0]):
        codes.radius = int(np.quantile(np.concatenate(far), COVER, method="higher"))
    return codes


class Shard:
    """The substring indexes of a set of rows."""

    def __init__(self, codes: Codes, ids: np.ndarray, x: np.ndarray):
        if len(np.unique(ids)) < len(ids):
            order = np.lexsort([*x.T[::-1], ids])
            first = np.r_[True, ids[order][1:] != ids[order][:-1]]
            ids, x = ids[order][first], x[order][first]
        self.ids, self.x = ids, x
        self.codes, self.own = codes, codes.encode(self.x)
        self.width = -(-codes.bits // PARTS)
        self.tables = []
        for p in range(PARTS):
            by = np.argsort(self.own[:, p], kind="stable")
            values, start = np.unique(self.own[by, p], return_index=True)
            self.tables.append((by, values, np.r_[start, len(by)]))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within the radius of ``code``: those that share a
        substring within radius // PARTS, confirmed on the whole code."""
        seen = np.zeros(len(self.ids), bool)
        for p, (by, values, start) in enumerate(self.tables):
            # The probes that hit something: present values within the substring radius.
            hit = np.flatnonzero(_BITS[values ^ code[p]] <= radius // PARTS)
            size = start[hit + 1] - start[hit]
            if size.sum():
                ends = np.cumsum(size)
                seen[by[np.repeat(start[hit] - (ends - size), size) + np.arange(ends[-1])]] = True
        rows = np.flatnonzero(seen)
        return rows[hamming(self.own[rows], code) <= radius]

    def nearest(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, float]]:
        code = self.codes.encode(q[None, :])[0]
        radius = self.codes.radius
        while True:
            rows = self.within(code, radius)
            rows = rows[self.ids[rows] != query_id]
            if len(rows) >= k or radius >= self.codes.bits:
                break
            radius += PARTS
        d = np.sqrt(((self.x[rows] - q) ** 2).sum(axis=1))
        best = np.lexsort([self.ids[rows], d])[:k]
        return [(int(self.ids[rows[i]]), float(d[i])) for i in best]


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v: array of doubles) of the rows that take part."""
    v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    sane = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(sane, F.lit(False))
                & F.exists("v", lambda x: x != 0))
    common = (v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
              .select(F.col("d").alias("dimension")))
    return v.join(F.broadcast(common), F.size("v") == F.col("dimension")).select("vec_id", "v")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def search(vectors: DataFrame, k: int = 10, query_every: int = 100, fit_rows: int = FIT_ROWS,
           vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose
    id is divisible by ``query_every``, among all other rows."""
    spark = vectors.sparkSession
    limit_batches(spark, 2048)
    rows = usable(vectors, vec_id, embedding)
    sample = (rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_rows)).toArrow()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not sample.num_rows:
        return empty
    codes = learn(_matrix(sample.column("v").combine_chunks()), k)
    n = rows.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(-(-n // SHARD_ROWS), min(parts, -(-n // SMALL_SHARD)))
    own = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    queries = (rows.where(F.col("vec_id") % query_every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
               .select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("query"),
                       "vec_id", "v"))
    stream = (rows.select(own.alias("shard"), F.lit(False).alias("query"), "vec_id", "v").unionByName(queries)
              .repartition(shards, "shard").sortWithinPartitions("shard", "query"))
    names = ["query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, index = None, [], None
        for batch in batches:
            key = batch.column("shard").to_numpy() * 2 + batch.column("query").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                shard, is_query = divmod(int(key[a]), 2)
                if shard != at:
                    at, held, index = shard, [], None
                ids, x = part.column("vec_id").to_numpy(), _matrix(part.column("v"))
                if not is_query:
                    held.append((ids, x))
                    continue
                if index is None and held:
                    index = Shard(codes, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                    held = []
                if index is None:
                    continue
                for lo in range(0, len(ids), 256):
                    out = [(int(q), i, d) for q, v in zip(ids[lo:lo + 256], x[lo:lo + 256])
                           for i, d in index.nearest(int(q), v, k)]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)

    found = stream.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
