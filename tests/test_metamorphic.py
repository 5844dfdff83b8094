"""Metamorphic properties: duplicated events and input order change nothing."""
from pyspark.sql import functions as F

from tidemark.plans.marts import Marts
from tidemark.sources.adapters import raw_events

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_duplicated_event_does_not_change_growth(spark):
    raw = raw_events(spark, SF)
    dup = raw.unionByName(raw.filter(F.col("event_type") == "view"))
    a, b = Marts(raw).growth_accounting, Marts(dup).growth_accounting
    assert rows(a) == rows(b)
    ea, eb = Marts(raw).engagement_depth, Marts(dup).engagement_depth
    assert rows(ea.select("period_grain", "period_start", "active_users")) == \
        rows(eb.select("period_grain", "period_start", "active_users"))


def test_input_order_and_partitioning_do_not_matter(spark):
    raw = raw_events(spark, SF)
    shuffled = raw.repartition(7, F.rand(3)).sortWithinPartitions(F.rand(5))
    for attr in ("growth_accounting", "cohort_retention_triangle", "dim_users"):
        assert rows(getattr(Marts(raw), attr)) == rows(getattr(Marts(shuffled), attr)), attr
