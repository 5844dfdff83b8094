"""Vector codes by product quantization with active-entry Lloyd rounds.

Components become integers, a vector is cut into equal parts, and each part is
replaced by the index of its codebook's nearest entry. The codebooks start as
the parts of the smallest ids and are refined in rounds: assign every part, then
move each entry to the floor of its parts' mean.

Rows carry their state: each part's entry and its exact distance. After an
update only some entries have moved. A part whose own entry stayed where it was
still has that entry as the nearest of all that stayed, at the stored distance;
so it is compared with the moved entries only. A part whose entry moved is
compared with all. Equal distances go to the lower index either way, so the
result is that of full rescans.

A round is one pass that writes the state as a table in the shared folder (a
lost executor repeats tasks, not rounds) and, in the same pass, each task's sums
and counts by part and entry; these are added up by Spark, and the driver gets
one row for each entry. Nothing is dealt by vector or entry, so crowded entries
need no care. The table of the round before is removed.

Defined results: rows whose vector is null or holds null or non-finite
components are left out, as are vectors of another length than the most common
one (the longer of two equally common). Components beyond +-2**26 after scaling
count as that bound. A length that isn't a multiple of the number of parts is
filled up with zeros. With fewer rows than entries there are as many entries as
rows. Rows with equal ids follow by their vectors, null ids come last; repeated
rows are repeated. Other columns are ignored; an empty table has no result.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.sinks import drop_path
from ..session import scratch_path
from .textcols import limit_batches

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LIMIT = 1 << 26
CODED = ("vec_id", "label", "codes", "distances", "error")
_FINITE = ("embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) "
           "AND abs(x) < double('Infinity'))")


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) within +-LIMIT."""
    return np.clip(np.floor(SCALE * x.astype(np.float64)), -LIMIT, LIMIT).astype(np.int64)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of integers. Where every term fits a
    double's 53 bits the products run as floating-point ones, which are exact then."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * largest * largest * max(x.shape[1], 1) < 1 << 52 else np.int64
    a, b = x.astype(kind), entries.astype(kind)
    return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)


def scan(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, its distance) of each row; the lower index of equals."""
    d = distances(x, entries)
    code = d.argmin(axis=1)
    return code, d[np.arange(len(x)), code]


def rescan(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray,
           distance: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The same from the last round's result, and the number of comparisons:
    rows with an unmoved entry look at moved ones only."""
    code, distance = code.copy(), distance.copy()
    lost = moved[code]
    active = np.flatnonzero(moved)
    if lost.any():
        code[lost], distance[lost] = scan(x[lost], entries)
    held = np.flatnonzero(~lost)
    if len(held) and len(active):
        near, d = scan(x[held], entries[active])
        near = active[near]
        wins = (d < distance[held]) | ((d == distance[held]) & (near < code[held]))
        code[held[wins]], distance[held[wins]] = near[wins], d[wins]
    return code, distance, int(lost.sum()) * len(entries) + len(held) * len(active)


def moved_means(books: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The books with each used entry at the floor of its parts' mean."""
    used = counts > 0
    out = books.copy()
    out[used] = sums[used] // counts[used][:, None]
    return out


def digest(books: np.ndarray) -> str:
    """sha256 of all components as decimals, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _kept(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
                          "label").where(_FINITE)


def _length(kept: DataFrame) -> int | None:
    found = (kept.groupBy(F.size("embedding").alias("n")).count().where("n > 0")
             .orderBy(F.desc("count"), F.desc("n")).limit(1).collect())
    return found[0].n if found else None


def _state_schema(vectors: DataFrame):
    """Rows of the state, and (with ``part``) a task's sums."""
    label = vectors.schema["label"].dataType.simpleString()
    return vectors.sparkSession.createDataFrame([], (
        f"vec_id long, label {label}, components binary, codes binary, distances binary, error long, "
        "part int, entry int, n long, sums array<long>")).schema


def _round(rows: DataFrame, schema, books: np.ndarray, moved: np.ndarray | None, path: str) -> None:
    """Assign all rows to ``books`` and write state and sums. ``moved`` is None in
    the first round, whose rows hold vectors; later ones hold the state before."""
    parts, entries, width = books.shape
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((books, moved))
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, moved = shared.value
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        label_type = None
        for batch in batches:
            n, label_type = batch.num_rows, batch.column("label").type
            if not n:
                continue
            if moved is None:
                x = integers(batch.column("embedding").flatten().to_numpy(zero_copy_only=False)).reshape(n, -1)
                x = np.pad(x, ((0, 0), (0, parts * width - x.shape[1])))
                code, far = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
            else:
                x, code, far = (np.frombuffer(b"".join(batch.column(c).to_pylist()), t).reshape(n, -1).astype(np.int64)
                                for c, t in (("components", "<i4"), ("codes", "u1"), ("distances", "<i8")))
            for j in range(parts):
                mine = x[:, j * width:(j + 1) * width]
                if moved is None:
                    code[:, j], far[:, j] = scan(mine, books[j])
                else:
                    code[:, j], far[:, j], _ = rescan(mine, books[j], moved[j], code[:, j], far[:, j])
                counts[j] += np.bincount(code[:, j], minlength=entries)
                for i in range(width):  # at most 2**39 in a batch, so exact
                    sums[j, :, i] += np.bincount(code[:, j], mine[:, i], minlength=entries).astype(np.int64)
            none = pa.nulls(n)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"), _bytes(x.astype("<i4")), _bytes(code.astype("u1")), _bytes(far.astype("<i8")),
                pa.array(far.sum(axis=1)), none.cast(pa.int32()), none.cast(pa.int32()), none.cast(pa.int64()), none.cast(pa.list_(pa.int64()))], names)
        part, entry = np.nonzero(counts)
        if len(part):
            none = pa.nulls(len(part))
            yield pa.RecordBatch.from_arrays([
                none.cast(pa.int64()), none.cast(label_type), *[none.cast(pa.binary())] * 3, none.cast(pa.int64()), pa.array(part, pa.int32()),
                pa.array(entry, pa.int32()), pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names)

    rows.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)


def _bytes(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    rows = np.ascontiguousarray(rows)
    width = rows.itemsize * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.py_buffer(rows)])


def _added(state: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts by part and entry over all tasks: one small row each."""
    sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
    rows = (state.where("part IS NOT NULL").groupBy("part", "entry")
            .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(books.shape[2])]).alias("sums")).collect())
    for r in rows:
        counts[r.part, r.entry], sums[r.part, r.entry] = r.n, r.sums
    return sums, counts


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Every kept row of ``vectors`` (vec_id, embedding, label) with its codes (a
    byte for each part), their distances (8 bytes each) and the sum of these, and
    the final codebooks (part, entry, component)."""
    if not 0 < entries <= 256:
        raise ValueError("codes are bytes: 1 to 256 entries")
    spark: SparkSession = vectors.sparkSession
    kept = _kept(vectors)
    length = _length(kept)
    schema = _state_schema(vectors)
    if length is None:
        return spark.createDataFrame([], schema).select(*CODED), np.zeros((parts, 0, 0), np.int64)
    kept = kept.where(F.size("embedding") == length)
    limit_batches(spark, min(8192, max(16, (1 << 19) // length)))
    width = -(-length // parts)
    head = kept.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    start = integers(np.array([r.embedding for r in head]).reshape(len(head), -1))
    start = np.pad(start, ((0, 0), (0, parts * width - length)))
    books = start.reshape(len(head), parts, width).transpose(1, 0, 2).copy()

    before, rows, moved = None, kept, None
    for i in range(rounds + 1):
        path = scratch_path(spark, f"vector-codes-{i}")
        _round(rows, schema, books, moved, path)
        if before:
            drop_path(spark, before)
        before, state = path, spark.read.schema(schema).parquet(path)
        if i < rounds:
            new = moved_means(books, *_added(state, books))
            books, moved = new, (new != books).any(axis=2)
        rows = state.where("codes IS NOT NULL").select("vec_id", "label", "components", "codes", "distances", "error")
    return rows.select(*CODED), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with the error of each row's label (null labels together). Errors
    are added up before the join, so a frequent label is one row on its other side."""
    by_label = coded.groupBy(F.col("label").alias("same_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("same_label"))).drop("same_label")
