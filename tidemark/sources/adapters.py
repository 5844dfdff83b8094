"""Adapters from the driver's Parquet tables to the raw event schema.

The driver ships TPC-H-like tables plus a generic ``events`` stream; these
functions reshape them into the nine raw event columns (+ ``loaded_at``) the
engine ingests. The shapes are fixed so that an independent SQL engine can
derive exactly the same rows (see ``__spark_entry__.oracle_sql``).

``raw_events``: dirty on purpose (blank strings, mixed case, padding, nulls)
so that staging's cleaning rules are exercised. ``raw_orders``: 80 months of
order history, the only driver data that exercises the monthly grain.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import read_table


def _country_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> lower-cased nation name (null for nation key 0).

    ``nation`` is the fixed 25-row TPC-H table; Spark's size-checked
    broadcast threshold turns this into a map-side join.
    """
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return (cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
            .select(F.col("c_custkey"),
                    F.when(F.col("n_nationkey") > 0, F.lower("n_name")).alias("country")))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")  # evaluated once per row (subexpression elimination)
    k4, k3 = k % 4, k % 3
    et = F.col("event_type")
    shaped = ev.select(
        F.col("ts").alias("event_time"),
        F.col("user_id"),
        F.when(k4 == 0, "F").when(k4 == 1, " M ").when(k4 == 2, "").alias("gender"),
        F.when(k % 7 == 0, F.concat(F.lit(" "), F.upper(et), F.lit(" ")))
         .otherwise(et).alias("event_type"),
        F.when(et == "purchase",
               F.when(k3 == 0, "Travel").when(k3 == 1, "dining ").otherwise(""))
         .alias("transaction_category"),
        F.when(et.isin("purchase", "signup"), F.col("value")).alias("miles_amount"),
        F.when(k4 == 0, "ios").when(k4 == 1, " Android").when(k4 == 2, "WEB").alias("platform"),
        F.when(k3 == 0, "google").when(k3 == 1, "Organic ").alias("utm_source"),
        F.col("ts").alias("loaded_at"),
    )
    countries = _country_by_customer(spark, sf_dir)
    return (shaped.join(countries, shaped.user_id == countries.c_custkey, "left")
            .drop("c_custkey")
            .select("event_time", "user_id", "gender", "event_type", "transaction_category",
                    "miles_amount", "platform", "utm_source", "country", "loaded_at"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderdate", "o_custkey", "o_orderpriority", "o_totalprice", "o_orderstatus"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    st = F.col("o_orderstatus")
    return (orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
            .select(F.col("o_orderdate").alias("event_time"),
                    F.col("o_custkey").alias("user_id"),
                    F.lit(None).cast("string").alias("gender"),
                    F.lit("order").alias("event_type"),
                    F.col("o_orderpriority").alias("transaction_category"),
                    F.col("o_totalprice").alias("miles_amount"),
                    F.when(st == "F", "ios").when(st == "O", "android").otherwise("web").alias("platform"),
                    F.lit(None).cast("string").alias("utm_source"),
                    F.col("c_mktsegment").alias("country"),
                    F.col("o_orderdate").alias("loaded_at")))


RAW_ADAPTERS = {"events": raw_events, "orders": raw_orders}
