"""Validated ingest of event CSV files into the raw Parquet table.

* RFC 4180 quoting: quoted commas, doubled quotes and newlines are text. (A
  file with quoted newlines can't be split, so one file is one task.)
* columns are taken by name: files are grouped by their header, so files of
  one folder may order their columns differently or have extra ones; every
  file must have the nine required columns;
* a row with too few or too many fields aborts the load, as does an
  ``event_time`` that is missing or does not parse (ISO text; offsets are
  converted to UTC, naive values are taken as UTC); the previous table stays;
* ``miles_amount`` is parsed leniently (not a number -> null);
* one ``loaded_at`` value per load, passed in by the caller;
* each row carries the path of the file it came from (``source_file``).

Bad rows are counted with ``observe()`` during the single write pass; the new
table is written next to the target and only swapped in when there are none.
The stream (``tidemark.streaming``) reads its files through the same functions.
"""
from __future__ import annotations

import csv
import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions import ts_ntz
from ..plans import sinks
from ..session import ensure_utc

# Fixed: the nine required input columns.
EXPECTED_COLUMNS = ["event_time", "user_id", "gender", "event_type", "transaction_category",
                    "miles_amount", "platform", "utm_source", "country"]
# Fallback layouts tried after ISO-8601 (which also covers offsets and 'T'):
# slash-separated, month first as a pandas-based loader reads ambiguous dates.
FALLBACK_TIME_FORMATS = ["yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm",
                         "MM/dd/yyyy"]
# Fixed: pandas' default missing-value tokens (read_csv ``na_values`` default).
PANDAS_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                    "nan", "null"]


# Partition column of the stored raw table (an addition to the ten raw columns).
RAW_DAY_COLUMN = "event_date"


class IngestError(ValueError):
    pass


# Holds the text of a row that does not fit its header; not a column of the result.
CORRUPT = "_row_as_read"
# Added to the raw columns: the path of the file that a row came from.
SOURCE_FILE = "source_file"


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The data files at a file, folder or glob path, in order."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for st in fs.globStatus(p) or []:
        inner = fs.listStatus(st.getPath()) if st.isDirectory() else [st]
        found += [i.getPath() for i in inner if i.isFile()]
    return sorted(str(f.toString()) for f in found if not f.getName().startswith(("_", ".")))


def csv_header(spark: SparkSession, file: str) -> list[str]:
    """Column names of one file: its first line, read through the file system
    without a Spark job and without the rest of the file. (A header is one line;
    a quoted newline in a column name isn't supported.)"""
    jvm = spark.sparkContext._jvm
    p, fs = sinks._fs(spark, file)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"), 8192)
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return next(csv.reader([line.removeprefix("\ufeff")])) if line else []


def check_header(file: str, columns: list[str]) -> None:
    """Every required column, each name once."""
    lacking = [c for c in EXPECTED_COLUMNS if c not in columns]
    if lacking:
        raise IngestError(f"{file}: the header lacks {', '.join(lacking)}")


def headers_of(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by header. A header costs one short read, made by 32 threads; no
    Spark job runs for it."""
    with ThreadPoolExecutor(max_workers=32) as pool:
        columns = list(pool.map(lambda f: tuple(csv_header(spark, f)), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for f, cols in zip(files, columns):
        check_header(f, list(cols))
        groups.setdefault(cols, []).append(f)
    return groups


def _read_group(spark: SparkSession, columns: tuple[str, ...], files: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, CORRUPT)])
    return (spark.read.option("header", True).option("mode", "PERMISSIVE").option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("columnNameOfCorruptRecord", CORRUPT)
            .schema(schema).csv(files).select(*[F.col(f"`{c}`") for c in schema.names if c != SOURCE_FILE],
                                              F.col("_metadata.file_path").alias(SOURCE_FILE)))


def typed_events(text: DataFrame, loaded_at: dt.datetime, pandas_na: bool = False) -> DataFrame:
    """All-string rows -> typed raw events; ``event_time`` is null where it did not parse."""
    cols = text.columns
    if pandas_na:
        text = text.select(*[c if c == CORRUPT else F.when(F.col(c).isin(PANDAS_NA_TOKENS), None).otherwise(F.col(c)).alias(c)
                             for c in cols])
    t = F.trim(F.col("event_time"))
    parsed = F.coalesce(F.try_to_timestamp(t),
                        *[F.try_to_timestamp(t, F.lit(fmt)) for fmt in FALLBACK_TIME_FORMATS]
                        ).cast("timestamp_ntz")
    miles = F.expr("try_cast(trim(miles_amount) AS double)")
    typed = {"event_time": parsed, "miles_amount": F.when(~F.isnan(miles), miles)}
    return text.select(*[typed.get(c, F.col(c)).alias(c) for c in cols], ts_ntz(loaded_at).alias("loaded_at"))


def read_event_files(spark: SparkSession, files: list[str], loaded_at: dt.datetime,
                     pandas_na: bool = False) -> DataFrame:
    """Typed raw events of CSV files (lazy), with ``CORRUPT``: the text of rows
    that do not fit their header. Columns that only some files have are null
    in the others."""
    ensure_utc(spark)
    if not files:
        raise IngestError("no input files")
    out = None
    for columns, group in headers_of(spark, files).items():
        part = _read_group(spark, columns, group)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    rest = [c for c in out.columns if c != CORRUPT]
    return typed_events(out.select(*rest, CORRUPT), loaded_at, pandas_na)


def read_events_csv(spark: SparkSession, path: str, loaded_at: dt.datetime,
                    pandas_na: bool = False) -> DataFrame:
    """Typed raw events at a path (lazy).

    ``pandas_na`` turns pandas' default NA tokens (``NA``, ``null``, ``NaN``
    ...) into nulls, as a pandas-based loader would; off by default so that
    a literal ``NA`` (a country code) survives.
    """
    return read_event_files(spark, list_files(spark, path), loaded_at, pandas_na).drop(CORRUPT)


def bad_rows() -> list:
    """Aggregates that count what makes a load fail."""
    return [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(CORRUPT).isNotNull()).alias("misfits"),
            F.count_if(F.col("event_time").isNull()).alias("untimed")]


def check_counts(counts: dict) -> None:
    if counts["misfits"] or counts["untimed"]:
        raise IngestError(f"load stopped: {counts['misfits']} rows don't fit their header, "
                          f"{counts['untimed']} have no readable event_time")


def ingest_events_csv(spark: SparkSession, csv_path: str, raw_path: str,
                      loaded_at: dt.datetime | None = None, pandas_na: bool = False) -> int:
    """Load ``csv_path`` into the Parquet table at ``raw_path`` (replace),
    partitioned by the event day (``event_date``).

    Returns the number of rows loaded. Raises ``IngestError`` (and keeps the
    previous table) if any ``event_time`` is missing or unparseable.
    """
    loaded_at = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    df = read_event_files(spark, list_files(spark, csv_path), loaded_at, pandas_na)
    obs = Observation("ingest")
    observed = df.observe(obs, *bad_rows()).drop(CORRUPT)
    staging = f"{raw_path.rstrip('/')}.loading-{uuid.uuid4().hex[:12]}"
    sinks.heal_swap(spark, raw_path)
    # Partitioned by event day so incremental staging reads prune whole days;
    # rebalanced on it, so a day is few files.
    try:
        (observed.withColumn(RAW_DAY_COLUMN, F.to_date("event_time")).hint("rebalance", RAW_DAY_COLUMN)
         .write.mode("overwrite").partitionBy(RAW_DAY_COLUMN).parquet(staging))
        counts = obs.get
        check_counts(counts)
        sinks.swap_in(spark, staging, raw_path)
    finally:
        sinks.drop_path(spark, staging)
    return int(counts["rows"])


def write_events_csv(df: DataFrame, path: str) -> None:
    """Write raw events as header CSV with microsecond timestamps and
    whitespace preserved (used to round-trip fixtures through the loader)."""
    (df.write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("quote", '"').option("escape", '"').csv(path))
