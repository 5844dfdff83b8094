"""Storage sinks over plain Parquet directories (no table format needed).

* ``replace``            - full rewrite (static overwrite).
* ``overwrite_partitions`` - replace exactly the partitions present in the
  output (dynamic partition overwrite); other partitions are untouched.
* ``upsert``             - MERGE on a unique key, scoped to the partitions the
  incoming rows touch: read only those partitions, drop rows whose key is
  incoming (left anti join), add the incoming rows, dynamic-overwrite.

Watermarks are read from the partition listing first, so finding
``max(event_time)`` scans one date partition instead of the table.
"""
from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """A committed table: ``_SUCCESS`` present, or (when success markers are
    disabled) data entries without a pending ``_temporary`` from a failed or
    running write. A half-written folder is treated as absent, so the next
    run rebuilds it instead of merging into it."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return False
    if fs.exists(jvm_child(spark, path, "_SUCCESS")):
        return True
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return bool(names) and "_temporary" not in names and any(not n.startswith(("_", ".")) for n in names)


def jvm_child(spark: SparkSession, path: str, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/" + name)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a run-scoped intermediate folder this job created."""
    p, fs = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    if not fs.mkdirs(p):
        raise OSError(f"cannot make {path}")


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a top-level ``column=value`` partition directory, from the
    file-system listing only (no data is read)."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    prefix = f"{column}="
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            out.append(name[len(prefix):])
    return out


def max_partition_date(spark: SparkSession, path: str, column: str) -> dt.date | None:
    vals = [v for v in partition_values(spark, path, column) if v != "__HIVE_DEFAULT_PARTITION__"]
    return max(dt.date.fromisoformat(v) for v in vals) if vals else None


def max_event_time(spark: SparkSession, path: str, ts_col: str,
                   date_partition: str | None = None) -> dt.datetime | None:
    """``max(ts_col)`` of a stored table; with a date partition column only
    the newest partition is scanned."""
    if not exists(spark, path):
        return None
    df = spark.read.parquet(path)
    if date_partition is not None:
        newest = max_partition_date(spark, path, date_partition)
        if newest is None:
            return None
        df = df.filter(F.col(date_partition) == F.lit(newest))
    return df.agg(F.max(ts_col)).first()[0]


def replace(df: DataFrame, path: str, partition_by: str | None = None,
            cluster_by: tuple[str, ...] = ()) -> None:
    """Full rewrite.

    Rows are rebalanced on the partition column, so a value lands in as few
    files as its size asks for: AQE merges small partitions and splits large
    ones (one date may be many tasks). Within a task they are sorted by
    partition then cluster columns, so files carry tight min/max statistics
    on the cluster columns for later predicate pushdown."""
    if partition_by:
        df = df.hint("rebalance", partition_by)
    if partition_by or cluster_by:
        df = df.sortWithinPartitions(*([partition_by] if partition_by else []), *cluster_by)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: str,
                         cluster_by: tuple[str, ...] = ()) -> None:
    """Dynamic partition overwrite, rebalanced like ``replace``: few files for
    each partition, and several tasks for a large one.

    ``df`` may read the partitions it replaces: files are written to a staging
    folder and move in when all tasks are done, so a task that is retried still
    finds the old ones."""
    (df.hint("rebalance", partition_by).sortWithinPartitions(partition_by, *cluster_by)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_by).parquet(path))


def bucket_of(key: str, buckets: int):
    """The number of the bucket that Spark's bucketed tables put a key in."""
    return F.pmod(F.hash(key), F.lit(buckets)).cast("int")


@contextmanager
def bucketed_table(spark: SparkSession, path: str, schema: T.StructType, partition_by: str, key: str, buckets: int):
    """The name under which the folder at ``path`` is a bucketed table for now.

    The folder has one partition for each bucket (``partition_by`` must be
    ``bucket_of(key, buckets)``), written through such a table, so file names
    carry the bucket. Spark then knows how the stored rows are distributed: a
    join on the key needs no exchange on their side, and a dynamic overwrite
    replaces single buckets. Only the catalog entry is temporary."""
    name = f"bucketed_{uuid.uuid4().hex[:16]}"
    make_folder(spark, path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{location}') "
              f"PARTITIONED BY (`{partition_by}`) CLUSTERED BY (`{key}`) INTO {int(buckets)} BUCKETS")
    try:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace_bucketed(df: DataFrame, path: str, partition_by: str, key: str, buckets: int) -> None:
    """Full rewrite of a bucketed folder: written beside it and swapped in."""
    spark = df.sparkSession
    rows = df.select(*[c for c in df.columns if c != partition_by], bucket_of(key, buckets).alias(partition_by))
    staging = f"{path.rstrip('/')}.loading-{uuid.uuid4().hex[:12]}"
    try:
        with bucketed_table(spark, staging, rows.schema, partition_by, key, buckets) as name:
            rows.repartition(int(buckets), key).write.insertInto(name)
        make_folder(spark, f"{staging}/.buckets={int(buckets)}")
        swap_in(spark, staging, path)
    finally:
        drop_path(spark, staging)


def stored_buckets(spark: SparkSession, path: str) -> int | None:
    """The number of buckets of a folder that ``replace_bucketed`` wrote."""
    found = partition_values(spark, path, ".buckets")
    return int(found[0]) if found else None


def overwrite_buckets(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Replace the buckets present in ``df`` (columns in the table's order), one
    file for each: dealt otherwise, every task would write a file to every bucket."""
    spark, setting = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")   # insertInto takes it from the session only
    try:
        df.repartition(int(buckets), key).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)


class DuplicateKeyError(ValueError):
    pass


def mark_pending(spark: SparkSession, warehouse: str, stage: str, after: dt.datetime | None) -> dt.datetime | None:
    """Record durably that ``stage`` owes the days from ``after`` on (None:
    all), and return what it owes together with earlier records.

    A record is an empty folder whose name holds the bound, so recording is
    one file-system call that either happened or not. Records stay until
    ``clear_pending``: a run that dies in between leaves them to the next."""
    owed = pending(spark, warehouse, stage) + [after]
    make_folder(spark, f"{_pending_dir(warehouse, stage)}/after={after.isoformat().replace(':', '.') if after else 'all'}")
    return None if None in owed else min(owed)


def _pending_dir(warehouse: str, stage: str) -> str:
    return f"{warehouse.rstrip('/')}/_pending/{stage}"


def pending(spark: SparkSession, warehouse: str, stage: str) -> list[dt.datetime | None]:
    """Bounds that earlier runs recorded for ``stage`` and didn't work off."""
    names = partition_values(spark, _pending_dir(warehouse, stage), "after")
    return [None if n == "all" else dt.datetime.fromisoformat(n.replace(".", ":", 2)) for n in names]


def clear_pending(spark: SparkSession, warehouse: str, stage: str) -> None:
    drop_path(spark, _pending_dir(warehouse, stage))


def heal_swap(spark: SparkSession, path: str) -> None:
    """Put back a table that a killed swap left aside, or, if its successor did
    move in, remove it."""
    dst, fs = _fs(spark, path)
    asides = fs.globStatus(_fs(spark, f"{path.rstrip('/')}.replaced-*")[0])
    for st in sorted(asides or [], key=lambda s: -s.getModificationTime()):
        if fs.exists(dst):
            fs.delete(st.getPath(), True)
        elif not fs.rename(st.getPath(), dst):
            raise OSError(f"cannot put {st.getPath()} back to {path}")


def swap_in(spark: SparkSession, loaded: str, path: str) -> None:
    """Put the complete folder ``loaded`` in the place of ``path``.

    The old table is renamed aside first and only deleted once the new one is
    in place; if that fails it is renamed back. What a process left that was
    killed in between is made good first (``heal_swap``)."""
    heal_swap(spark, path)
    src, fs = _fs(spark, loaded)
    dst, _ = _fs(spark, path)
    aside, _ = _fs(spark, f"{path.rstrip('/')}.replaced-{loaded.rsplit('-', 1)[-1]}")
    if not fs.exists(src):
        raise OSError(f"nothing to move from {loaded}")
    had = fs.exists(dst)
    if had and not fs.rename(dst, aside):
        raise OSError(f"cannot move {path} aside")
    moved = False
    try:
        moved = fs.rename(src, dst)
    finally:
        if had and not moved and not fs.rename(aside, dst):
            raise OSError(f"cannot move {loaded} to {path}; the previous table is at {aside}")
    if not moved:
        raise OSError(f"cannot move {loaded} to {path}; the previous table is unchanged")
    if had:
        fs.delete(aside, True)


def dedupe_incoming(incoming: DataFrame, key: str, on_duplicate: str,
                    order_col: str = "loaded_at", hex_key: bool = False) -> DataFrame:
    """Resolve duplicate keys in a merge source.

    ``fail``: raise if any key occurs twice (a merge with ambiguous source
    rows is an error). ``keep_latest``: keep the row with the greatest
    ``order_col`` per key (ties broken by the full row hash). The check
    stops at the first duplicate it finds.
    """
    if on_duplicate == "fail":
        from ..operators.quality import repeated_values
        dup = repeated_values(incoming, F.col(key), key, "n", hex_key).limit(1).collect()
        if dup:
            raise DuplicateKeyError(f"duplicate merge key {key}={dup[0][0]!r} in incoming rows")
        return incoming
    if on_duplicate == "keep_latest":
        cols = incoming.columns
        best = F.max_by(F.struct(*cols), F.struct(F.col(order_col), F.xxhash64(*cols)))
        return incoming.groupBy(key).agg(best.alias("_r")).select("_r.*").select(*cols)
    raise ValueError(f"on_duplicate must be 'fail' or 'keep_latest', got {on_duplicate!r}")


def upsert(spark: SparkSession, path: str, incoming: DataFrame, key: str,
           partition_by: str, on_duplicate: str = "fail", cluster_by: tuple[str, ...] = (),
           hex_key: bool = False) -> None:
    """MERGE ``incoming`` into the Parquet table at ``path`` on ``key``.

    The key must never move between partitions (true for the event key,
    which contains the event time, and for a user bucket derived from the
    user id). Only partitions that appear in ``incoming`` are read and
    rewritten; the list of touched partitions is small (dates or buckets).
    ``incoming`` is used by several passes (duplicate check, touched list,
    merge), so it is persisted for the duration of the merge; a lost block is
    recomputed from its lineage. With ``hex_key`` (md5 keys in hex) keys are
    counted and joined by their 16 bytes.
    """
    cached = incoming.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        incoming = dedupe_incoming(cached, key, on_duplicate, hex_key=hex_key)
        if not exists(spark, path):
            replace(incoming, path, partition_by, cluster_by)
            return
        touched = [r[0] for r in incoming.select(partition_by).distinct().collect()]
        if not touched:
            return
        existing = spark.read.parquet(path).filter(F.col(partition_by).isin(touched))
        if hex_key:
            keys = incoming.select(F.unhex(key).alias("key_bytes"))
            kept = existing.join(keys, F.unhex(existing[key]) == keys["key_bytes"], "left_anti")
        else:
            kept = existing.join(incoming.select(key), key, "left_anti")
        merged = kept.unionByName(incoming.select(*existing.columns))
        overwrite_partitions(merged, path, partition_by, cluster_by=cluster_by)
    finally:
        cached.unpersist()
