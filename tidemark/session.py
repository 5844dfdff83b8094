"""Session construction and the shared scratch location."""
from __future__ import annotations

import logging
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Settings every tidemark job relies on. UTC is part of the metric contract
# (all period bucketing is UTC); AQE lets Spark coalesce small shuffle
# partitions, split skewed join partitions and switch join strategy from
# measured (not estimated) sizes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the tidemark defaults applied."""
    b = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         # remove reliable-checkpoint files once their DataFrame is unreachable
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime (SQL) settings to an existing session."""
    for k, v in BASE_CONF.items():
        spark.conf.set(k, v)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


#: Spark gives a frame of unknown size more bytes than this.
_UNKNOWN_BYTES = 1 << 60


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads (a partitioned table's pruned ones are
    left out), from Spark's own file listing; no job runs. Sources without a
    known size count as empty."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < _UNKNOWN_BYTES)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is the shared (HDFS / object store) location every
    executor can reach, and it must be configured: a machine-local folder
    would not survive the loss of the node that wrote it. Only in local mode
    (tests, a laptop) is a private temporary folder created when it is unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) "
                               "before running tidemark jobs on a cluster")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        log.warning("spark.checkpoint.dir unset; using local %s (local mode only)", root)
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def join_path(base: str, *parts: str) -> str:
    if "://" in base:
        return "/".join([base.rstrip("/"), *parts])
    return os.path.join(base, *parts)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return join_path(checkpoint_root(spark), "tidemark", f"{name}-{uuid.uuid4().hex[:12]}")
