"""Near-duplicate documents by HyperMinHash.

A document is its set of distinct word shingles. One 64-bit hash of a shingle
gives a bucket (its top bits) and a value; a bucket keeps its smallest value in
compressed form, the number of leading zeros (6 bits) and the mantissa bits
after them (10). Two documents have equal registers in a bucket about as often
as their sets overlap. Empty buckets, of short documents, copy a bucket that
both of two similar documents choose alike.

1. Equal sets are one class, represented by one row with the smallest doc_id:
   copies are never compared, however many there are.
2. Registers are cut into bands; documents that share a band are candidates. The
   bands are chosen so that a pair at the threshold is missed with a probability
   of at most ``MISS``.
3. Buckets of a band are gathered around their smallest member; that group's
   documents are compared in blocks: first by the Jaccard index estimated from
   the registers, corrected for registers that collide by chance, then, if the
   estimate is not clearly below the threshold, on the full sets. A block
   returns links that connect its documents, not all pairs. A large group is
   many blocks, in as many tasks, and each block also holds the same ``PIVOTS``
   documents of the group: near copies of one template are connected through
   these. Only documents that are then still apart from the group's largest part
   meet the other blocks, so the work grows with the group, not with its square,
   unless a group's documents share a band without being near copies.
4. Connected components of the links; one document of each stays.

Shingles are compared by their 64-bit hashes; two different ones among n have
the same hash with a probability of about n**2 / 2**65.

Defined results: a text without words, or null, has the empty set and is linked
with nothing; a text with fewer words than a shingle is one shingle. Rows that
share a doc_id are linked by their own texts only. A row without doc_id is linked with
nothing, has no component and is kept. Repeated rows have equal results (so
``kept`` holds for each copy of the row with the smallest doc_id). Extra columns
are ignored; an empty table has no result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch_path
from .components import connected_components
from .textcols import U64, flat, groups, limit_batches, lower_ascii, mix, powers, slices, span_hashes, words

BUCKETS = 256
MANTISSA = 10
MISS = 1e-7
#: Estimates this far below the threshold are not verified: over six standard
#: deviations of an estimate from 256 registers at any threshold.
MARGIN = 0.2
#: Documents in one block of a group.
BLOCK = 256
#: Documents of a large group that each of its blocks holds.
PIVOTS = 16
#: Expected share of registers that collide by chance is this times 2**-MANTISSA
#: times 4 s / (1 + s)**2 for sets whose sizes have the ratio s (Yu and Weber, HyperMinHash).
COLLISION = 0.169919487159739


def bands_for(threshold: float, buckets: int = BUCKETS, miss: float = MISS) -> tuple[int, int]:
    """(bands, registers in each): the longest bands that miss rarely enough."""
    for rows in range(12, 1, -1):
        if (1 - threshold**rows) ** (buckets // rows) <= miss:
            return buckets // rows, rows
    return buckets, 1


def _probes() -> np.ndarray:
    rng = np.random.default_rng(11)
    return np.concatenate([rng.integers(0, BUCKETS, (BUCKETS, 64)),
                           (np.arange(BUCKETS)[:, None] + np.arange(1, BUCKETS)) % BUCKETS], axis=1)


_PROBES = _probes()


def registers(distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(registers, which of them are filled) of ascending distinct hashes."""
    bucket = (distinct >> U64(56)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    part, exponent = np.frexp(((distinct[first] & U64((1 << 56) - 1)) >> U64(3)).astype(float))
    digits = np.clip(np.floor((part * 2 - 1) * (1 << MANTISSA)), 0, (1 << MANTISSA) - 1).astype(np.uint16)
    out, filled = np.zeros(BUCKETS, np.uint16), np.zeros(BUCKETS, bool)
    out[bucket[first]] = ((53 - exponent).astype(np.uint16) << np.uint16(MANTISSA)) | digits
    filled[bucket[first]] = True
    return out, filled


def dense(values: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Registers with each empty bucket a copy of the first filled one of its probes."""
    if filled.all() or not filled.any():
        return values
    empty = np.flatnonzero(~filled)
    probes = _PROBES[empty]
    out = values.copy()
    out[empty] = values[probes[np.arange(len(empty)), np.argmax(filled[probes], axis=1)]]
    return out


def estimates(values: np.ndarray, filled: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Estimated Jaccard index of all pairs of a block (a row for each document)."""
    same = np.zeros((len(values), len(values)))
    either = np.zeros_like(same)
    for j in range(values.shape[1]):
        f = filled[:, j]
        v = np.where(f, values[:, j].astype(np.int32), -1)
        same += (v[:, None] == v[None, :]) & f[:, None]
        either += f[:, None] | f[None, :]
    s = sizes[:, None] / np.maximum(sizes[None, :], 1)
    chance = COLLISION * 2.0**-MANTISSA * 4 * s / (1 + s) ** 2
    return (same - either * chance) / np.maximum(either, 1)


def shingle_hashes(raw: np.ndarray, off: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The ascending distinct shingle hashes of each text."""
    raw = lower_ascii(raw)
    starts, ends, first = words(raw, off)
    h = span_hashes(raw, starts, ends)
    factor = powers(size + 1, 0xA24BAED4963EE407)
    n = max(len(h) - size + 1, 0)
    rolled = np.zeros(n, U64)
    for i in range(size):
        rolled += h[i:i + n] * factor[i]
    rolled = mix(rolled + U64(size))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield np.unique(rolled[a:b - size + 1])
        elif b > a:
            yield mix(np.array([(h[a:b] * factor[:b - a]).sum(dtype=U64) + U64(b - a)], U64))
        else:
            yield np.zeros(0, U64)


def set_hash(distinct: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, whatever its order."""
    a = mix(distinct + U64(0x8CB92BA72F3D8DD7)).sum(dtype=U64)
    b = mix(distinct ^ U64(0xD1B54A32D192ED03)).sum(dtype=U64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("text_key"))


def sketch(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_key: hash of the text, n_shingles, h1, h2: hash of the set, registers: binary)."""
    limit_batches(docs.sparkSession)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [(len(s), *set_hash(s), dense(*registers(s)).astype("<u2").tobytes() if len(s) else None)
                        for s in shingle_hashes(*flat(part.column("text")), shingle)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]],
                    ["doc_id", "text_key", "n_shingles", "h1", "h2", "registers"])

    return _keyed(docs).mapInArrow(run, "doc_id long, text_key long, n_shingles long, h1 long, h2 long, registers binary")


def _links_of(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect all documents of a block that the threshold connects."""
    sizes = np.array([len(s) for s in sets])
    regs = [registers(s) for s in sets]
    maybe = estimates(np.stack([r[0] for r in regs]), np.stack([r[1] for r in regs]), sizes) \
        >= percent / 100 - MARGIN
    np.fill_diagonal(maybe, False)
    some = np.flatnonzero(maybe.any(axis=1))
    if not len(some):
        return []
    inter = np.zeros((len(some), len(some)))
    if len(some) == 2:
        inter[0, 1] = inter[1, 0] = len(np.intersect1d(sets[some[0]], sets[some[1]], assume_unique=True))
    else:
        values, code = np.unique(np.concatenate([sets[i] for i in some]), return_inverse=True)
        row = np.repeat(np.arange(len(some)), sizes[some])
        shared = np.bincount(code) > 1
        number = np.cumsum(shared) - 1
        row, code = row[shared[code]], number[code[shared[code]]]
        by = np.argsort(code, kind="stable")
        row, code = row[by], code[by]
        for lo in range(0, int(shared.sum()), 4096):
            a, b = np.searchsorted(code, [lo, lo + 4096])
            has = np.zeros((len(some), 4096), np.float32)
            has[row[a:b], code[a:b] - lo] = 1
            inter += has @ has.T
    n = sizes[some]
    linked = maybe[np.ix_(some, some)] & (100 * inter >= percent * (n[:, None] + n[None, :] - inter))
    label = np.arange(len(some))
    while True:
        near = np.where(linked, label[None, :], len(some)).min(axis=1)
        new = np.minimum(label, near)
        if (new == label).all():
            break
        label = new
    return [(int(ids[some[i]]), int(ids[some[label[i]]])) for i in range(len(some)) if label[i] != i]


def linked(docs: DataFrame, classes: DataFrame, sketches: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(node, component) of the nodes of classes that confirmed links connect."""
    spark = docs.sparkSession
    count, rows = bands_for(percent / 100)
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("registers", 1 + 2 * rows * i, 2 * rows)) for i in range(count)])
    path = scratch_path(spark, "bands")
    sketches.join(classes, F.col("row") == F.col("node"), "left_semi").select(F.col("row").alias("node"), keys.alias("keys")) \
        .write.parquet(path)
    stored = spark.read.parquet(path)
    bands = stored.select("node", F.explode("keys").alias("key"))
    # Stored, the aggregates are plain sides of a join, of which Spark can split a frequent key.
    path = scratch_path(spark, "shared-bands")
    bands.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top") \
        .select("key", "hub").write.parquet(path)
    shared = spark.read.parquet(path)
    path = scratch_path(spark, "members")
    bands.join(shared, "key").select("hub", "node").distinct().write.parquet(path)
    members = spark.read.parquet(path)
    path = scratch_path(spark, "blocks")
    members.groupBy("hub").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks")).write.parquet(path)
    blocks = spark.read.parquet(path)
    path = scratch_path(spark, "wanted")
    classes.join(members.select("node").distinct(), "node", "left_semi").write.parquet(path)
    wanted = spark.read.parquet(path)
    read = _keyed(docs)
    if wanted.where("rows > 1").limit(1).count():
        # Each task drops its own repeats first, so that a frequent row is one row of a class.
        read = read.dropDuplicates(["doc_id", "text_key"])
    # Sorted on both sides at every size, so that the disk it takes grows in proportion.
    wanted = wanted.withColumnRenamed("text_key", "k").hint("merge")
    texts = read.join(wanted, (F.col("doc_id") == F.col("rep")) & (F.col("text_key") == F.col("k"))) \
        .select("node", "h1", "h2", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = list(shingle_hashes(*flat(part.column("text")), shingle))
                # Another text of this doc_id may have the same key.
                right = [i for i, (s, a, b) in enumerate(zip(found, part.column("h1").to_pylist(), part.column("h2").to_pylist()))
                         if set_hash(s) == (a, b)]
                if right:
                    yield pa.RecordBatch.from_arrays(
                        [part.column("node").take(pa.array(right)),
                         pa.array([found[i].astype("<u8").tobytes() for i in right], pa.binary())], ["node", "shingles"])

    # Stored, as both comparisons need them: reading them anew deals out all texts again.
    path = scratch_path(spark, "sets")
    texts.mapInArrow(sets, "node long, shingles binary").write.parquet(path)
    full = spark.read.parquet(path)

    def compared(dealt: DataFrame, name: str) -> DataFrame:
        work = dealt.join(full, "node").select("hub", "p", "q", "node", "shingles")
        work = work.repartition("hub", "p", "q").sortWithinPartitions("hub", "p", "q", "node")
        path = scratch_path(spark, name)
        work.mapInArrow(_compare(percent), "a long, b long").write.parquet(path)
        return spark.read.parquet(path)

    placed = members.join(blocks, "hub").withColumn("p", F.pmod(F.xxhash64("node", "hub"), F.col("blocks")).cast("int"))
    first = _within_blocks(placed)
    found = connected_components(compared(first, "links-in-blocks"))
    if not blocks.where("blocks > 1").limit(1).count():
        return found
    path = scratch_path(spark, "apart")
    _apart(placed, found).write.parquet(path)
    apart = spark.read.parquet(path)
    if not apart.limit(1).count():
        return found
    more = compared(_across_blocks(placed, apart), "links-across-blocks")
    return connected_components(found.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(more))


def _within_blocks(placed: DataFrame) -> DataFrame:
    """(hub, node, p, q) of each block of a group, with the group's pivots in every block;
    ``placed`` has hub, node, p (the node's block) and blocks (of its group)."""
    large = placed.where("blocks > 1")
    order = Window.partitionBy("hub").orderBy(F.xxhash64("node"), "node")
    pivots = large.withColumn("n", F.row_number().over(order)).where(F.col("n") <= PIVOTS)
    pivots = pivots.select("hub", "node", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("q"), F.col("p").alias("own")) \
        .where("q <> own").select("hub", "node", F.col("q").alias("p"), "q")
    return placed.select("hub", "node", "p", F.col("p").alias("q")).unionByName(pivots)


def _apart(placed: DataFrame, found: DataFrame) -> DataFrame:
    """(hub, node, p, blocks) of large groups' nodes outside the largest part of their group."""
    part = F.coalesce("component", F.col("placed.node"))
    named = placed.where("blocks > 1").alias("placed").join(found.alias("found"), F.col("placed.node") == F.col("found.node"), "left") \
        .select("hub", "placed.node", "p", "blocks", part.alias("part"))
    largest = named.groupBy("hub", "part").agg(F.count("*").alias("n")) \
        .groupBy("hub").agg(F.max(F.struct("n", "part")).alias("most")).select("hub", F.col("most.part").alias("main"))
    return named.join(largest, "hub").where("part <> main").select("hub", "node", "p", "blocks")


def _across_blocks(placed: DataFrame, apart: DataFrame) -> DataFrame:
    """(hub, node, p, q): blocks p of the nodes that are apart, each with every
    block q of all the group's nodes."""
    count = apart.groupBy("hub").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("apart_blocks"))
    left = apart.join(count, "hub").select(
        "hub", "node", F.pmod(F.xxhash64("hub", "node"), F.col("apart_blocks")).cast("int").alias("p"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("q"))
    right = placed.join(count, "hub").select(
        "hub", "node", F.explode(F.sequence(F.lit(0), F.col("apart_blocks") - 1)).alias("p"), F.col("p").alias("q"))
    return left.unionByName(right).distinct()


def _compare(percent: int):
    """The work of a task: links of each block (hub, p, q) of a sorted partition."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for group in groups(batches, ["hub", "p", "q"]):
            ids = group.column("node").to_numpy()
            sets_ = [np.frombuffer(b, "<u8") for b in group.column("shingles").to_pylist()]
            if len(ids) > 1:
                out += _links_of(ids, sets_, percent)
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    return compare


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text).

    Documents with 100 * intersection >= percent * union are linked; component_id
    is the smallest doc_id that links reach."""
    return judge(docs, shingle, percent).select("doc_id", "n_shingles", "component_id", "kept")


def judge(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """near_duplicates with text_key, xxhash64 of the text, and first: whether the row
    has the one doc_id and text that represent its component, or is in none."""
    spark = docs.sparkSession
    path = scratch_path(spark, "sketches")
    sketch(docs, shingle).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    sketches = spark.read.parquet(path)
    some = sketches.where("doc_id is not null and n_shingles > 0")
    # A class is named by the row that represents it, of which there may be repeats.
    path = scratch_path(spark, "classes")
    some.groupBy("h1", "h2", "doc_id", "text_key").agg(F.min("row").alias("node"), F.count("*").alias("rows")) \
        .groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "text_key", "node", "rows")).alias("c")) \
        .select("h1", "h2", F.col("c.doc_id").alias("rep"), "c.text_key", "c.node", "c.rows").write.parquet(path)
    classes = spark.read.parquet(path)
    found = linked(docs, classes, some, shingle, percent)
    path = scratch_path(spark, "components")
    classes.join(found, "node").groupBy("component").agg(F.min(F.struct("rep", "text_key")).alias("c")) \
        .select("component", F.col("c.rep").alias("component_id"), F.col("c.text_key").alias("first_key")).write.parquet(path)
    found = found.join(spark.read.parquet(path), "component").select("node", "component_id", "first_key")
    named = classes.join(found, "node", "left").select("h1", "h2", F.coalesce("component_id", "rep").alias("component_id"),
                                                       F.coalesce("first_key", "text_key").alias("first_key"))
    rows = sketches.select("doc_id", "text_key", "n_shingles",
                           F.when(F.expr("doc_id is not null and n_shingles > 0"), F.col("h1")).alias("s1"), "h2")
    joined = rows.join(named, (F.col("s1") == named["h1"]) & (rows["h2"] == named["h2"]), "left")
    component = F.coalesce(F.col("component_id"), F.col("doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return joined.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), kept.alias("kept"),
                         (kept & F.coalesce(F.col("text_key") == F.col("first_key"), F.lit(True))).alias("first"))
