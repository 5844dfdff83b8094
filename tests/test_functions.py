import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import (clean_text, event_key, next_period_start, period_index,
                                period_start, prior_period_start, surrogate_key)


def test_clean_text_g6(spark):
    df = spark.createDataFrame([(" Android",), ("",), (" sg ",), ("\tweb\t",), (None,)], "v string")
    got = df.select(clean_text(F.col("v"), "lower").alias("l"), clean_text(F.col("v"), "upper").alias("u")).collect()
    assert [r.l for r in got] == ["android", None, "sg", "web", None]
    assert [r.u for r in got] == ["ANDROID", None, "SG", "WEB", None]


def test_week_edges_g5(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),), (dt.date(2025, 1, 1),)], "d date")
    got = [r.w for r in df.select(period_start(F.lit("weekly"), F.col("d")).alias("w")).collect()]
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 1, 8), dt.date(2024, 12, 30)]


def test_prior_next_and_index(spark):
    df = spark.createDataFrame([("daily", dt.date(2024, 3, 1)), ("weekly", dt.date(2024, 3, 4)),
                                ("monthly", dt.date(2024, 3, 1))], "g string, p date")
    rows = df.select(prior_period_start(F.col("g"), F.col("p")).alias("pr"),
                     next_period_start(F.col("g"), F.col("p")).alias("nx")).collect()
    assert [r.pr for r in rows] == [dt.date(2024, 2, 29), dt.date(2024, 2, 26), dt.date(2024, 2, 1)]
    assert [r.nx for r in rows] == [dt.date(2024, 3, 2), dt.date(2024, 3, 11), dt.date(2024, 4, 1)]
    idx = spark.createDataFrame([("daily", dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
                                 ("weekly", dt.date(2024, 1, 1), dt.date(2024, 2, 26)),
                                 ("monthly", dt.date(2023, 11, 1), dt.date(2024, 2, 1))],
                                "g string, c date, a date")
    got = [r.i for r in idx.select(period_index(F.col("g"), F.col("c"), F.col("a")).alias("i")).collect()]
    assert got == [30, 8, 3]


def test_surrogate_key_nulls_and_text(spark):
    import hashlib
    df = spark.createDataFrame([("a", None)], "x string, y string")
    k = df.select(surrogate_key(F.col("x"), F.col("y")).alias("k")).first().k
    assert k == hashlib.md5(b"a|").hexdigest()


def test_event_key_canonical_text(spark):
    import hashlib
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 60), "7", "like", 12.5, "ios")],
                               "t timestamp_ntz, u string, e string, m double, p string")
    k = df.select(event_key(F.col("t"), F.col("u"), F.col("e"), F.col("m"), F.col("p")).alias("k")).first().k
    text = "2024-01-02 03:04:05.000060|7|like|12.500000000|ios"
    assert k == hashlib.md5(text.encode()).hexdigest()
