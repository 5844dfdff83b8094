"""Event-file stream -> incremental refresh per micro-batch.

``readStream`` watches a directory and delivers the names of new files (their
content is not read by the stream). Each micro-batch reads its files with the
batch loader's functions - quoting, columns by name for each file's header,
required columns, bad rows fatal - and hands the events to
``plans.refresh.refresh_events``: the same late-arrival lookback, cutoff and
keyed upserts as a scheduled batch run. Every write is an upsert on a
deterministic key, and days that a dead run left unfinished are recorded in
the warehouse, so replaying a micro-batch (at-least-once delivery into
``foreachBatch``) yields the same tables. The stream checkpoint lives in the
shared ``spark.checkpoint.dir``.

``trigger(availableNow=True)`` processes what has arrived and stops, which
is how a scheduler runs it; drop it for a continuously running query.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..params import RunParams
from ..plans import refresh
from ..session import ensure_utc, join_path, scratch_path
from ..sources.csv_ingest import CORRUPT, bad_rows, check_counts, read_event_files

# Fixed: the columns of Spark's binaryFile source; only the path is read.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def event_file_stream(spark: SparkSession, source_dir: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of the paths of files that arrive in ``source_dir``."""
    ensure_utc(spark)
    r = spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(source_dir).select("path")


def _batch_handler(warehouse: str, params: RunParams, loaded_at: dt.datetime | None,
                   with_periods: bool = False):
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stamp = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        files = sorted(r.path for r in batch.collect())   # names of one micro-batch, as Spark's driver lists them
        if not files:
            return
        # the refresh runs several jobs over the batch: keep it cached for them
        # (a lost block is simply re-read from the source files)
        events = read_event_files(spark, files, stamp).persist()
        try:
            check_counts(events.agg(*bad_rows()).first().asDict())
            windows = refresh.refresh_events(spark, events.drop(CORRUPT), warehouse, params)
            if with_periods:
                refresh.refresh_periods(spark, warehouse, params, changed_since=windows["changed_since"])
        finally:
            events.unpersist()
    return handle


def start_event_ingest(spark: SparkSession, source_dir: str, warehouse: str,
                       params: RunParams = RunParams(), checkpoint: str | None = None,
                       available_now: bool = True, loaded_at: dt.datetime | None = None,
                       max_files_per_trigger: int | None = None,
                       with_periods: bool = False) -> StreamingQuery:
    """Start the ingest query (caller awaits / stops it). With
    ``with_periods`` every micro-batch also refreshes the period marts
    (windowed re-classification of the recent periods)."""
    checkpoint = checkpoint or scratch_path(spark, "event-stream-checkpoint")
    w = (event_file_stream(spark, source_dir, max_files_per_trigger).writeStream
         .foreachBatch(_batch_handler(warehouse, params, loaded_at, with_periods))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def stage_files(spark: SparkSession, df: DataFrame, source_dir: str, name: str) -> None:
    """Deliver rows into a watched directory the way producers should: write
    the CSV elsewhere, then move the finished files in (a stream never sees a
    half-written file)."""
    tmp = scratch_path(spark, f"stage-{name}")
    (df.write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("quote", '"').option("escape", '"').csv(tmp))
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src = jvm.org.apache.hadoop.fs.Path(tmp)
    fs = src.getFileSystem(conf)
    dst_dir = jvm.org.apache.hadoop.fs.Path(source_dir)
    fs.mkdirs(dst_dir)
    for st in fs.listStatus(src):
        p = st.getPath()
        if p.getName().endswith(".csv"):
            fs.rename(p, jvm.org.apache.hadoop.fs.Path(join_path(source_dir, f"{name}-{p.getName()}")))
