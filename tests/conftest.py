import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.session import configure  # noqa: E402

RAW_SCHEMA = ("event_time timestamp_ntz, user_id string, gender string, event_type string, "
              "transaction_category string, miles_amount double, platform string, utm_source string, "
              "country string, loaded_at timestamp_ntz")
RAW_COLS = ["event_time", "user_id", "gender", "event_type", "transaction_category", "miles_amount",
            "platform", "utm_source", "country", "loaded_at"]
LOADED = dt.datetime(2024, 6, 1)


@pytest.fixture(scope="session")
def spark():
    b = (SparkSession.builder.master("local[4]").appName("tidemark-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    s = b.getOrCreate()
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    configure(s)
    s.sparkContext.setLogLevel("ERROR")
    yield s


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def make_raw(spark, rows):
    """rows: dicts with raw column names; event_time may be a date/datetime string."""
    out = []
    for r in rows:
        r = dict(r)
        t = r.get("event_time")
        if isinstance(t, str):
            r["event_time"] = ts(t if len(t) > 10 else t + " 12:00:00")
        r.setdefault("event_type", "like")
        r.setdefault("loaded_at", LOADED)
        out.append(tuple(r.get(c) for c in RAW_COLS))
    return spark.createDataFrame(out, RAW_SCHEMA)


@pytest.fixture
def raw(spark):
    return lambda rows: make_raw(spark, rows)
