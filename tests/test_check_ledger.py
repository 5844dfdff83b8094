"""Post-checks by partition: what changed is read, the rest is remembered."""
import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as dq
from tidemark.plans import check_ledger as cl, refresh, sinks
from tidemark.session import scratch_path

TYPES = ("like", "share")


@pytest.fixture(scope="module")
def warehouse(spark):
    from conftest import make_raw
    rows = [{"event_time": f"2024-01-{d:02d} 0{k}:00:00", "user_id": u, "platform": "ios", "country": "SG", "event_type": "like"}
            for d in range(1, 13) for k, u in enumerate("abc") if (d + k) % 3]
    wh = scratch_path(spark, "checked")
    refresh.refresh_all(spark, make_raw(spark, rows), wh, run_quality=False)
    return wh


def check(spark, wh):
    return cl.check_changed(spark, wh, TYPES)


def fault(spark, wh, table, value, change):
    """Rewrite one partition of a stored table."""
    part, path = refresh.LAYOUT[table][0], refresh.table_path(wh, table)
    df = change(spark.read.parquet(path).filter(F.col(part).cast("string") == value))
    spark.sparkContext.setCheckpointDir(scratch_path(spark, "faults"))
    sinks.overwrite_partitions(df.checkpoint(), path, part)


def test_faults_in_old_and_new_partitions(spark, warehouse):
    first = check(spark, warehouse)
    assert set(first.checked) == set(cl.CHECKED) and first.failing == [] and cl.require(first)
    names = {n for n, _, _ in first.totals}
    assert {"dim_first_event", "growth_segmented_prior_identity", "stg_events_unique_event_id", "day_base_matches_fact"} <= names

    # nothing was rewritten: nothing is read, the results are the stored ones
    jobs = []
    real, cl._failures = cl._failures, lambda *a: jobs.append(a)
    try:
        again = check(spark, warehouse)
    finally:
        cl._failures = real
    assert not jobs and again.checked == {} and again.totals == first.totals

    # a fault in an old partition, and one in the newest
    fault(spark, warehouse, "fct_growth_accounting", "2024-01-03", lambda df: df.withColumn(
        "new_users", F.expr("new_users + CASE WHEN period_grain = 'daily' AND country = 'all' THEN 1 ELSE 0 END")))
    fault(spark, warehouse, "fct_events", "2024-01-12", lambda df: df.unionByName(df.limit(1)))
    found = check(spark, warehouse)
    assert found.checked["fct_events"] == ["2024-01-12"] and found.checked[refresh.DAY_BASE] == ["2024-01-12"]
    # the partition, and those whose prior day or week it is
    assert found.checked["fct_growth_accounting"] == ["2024-01-03", "2024-01-04", "2024-01-10"]
    assert set(found.checked) == {"fct_events", refresh.DAY_BASE, "fct_growth_accounting"}
    assert {(n, v) for n, v, _ in found.failing} == {
        ("growth_identity", "2024-01-03"), ("growth_segmented_identity", "2024-01-03"),
        ("fct_events_unique_event_id", "2024-01-12"), ("day_base_matches_fact", "2024-01-12")}
    with pytest.raises(dq.DataQualityError, match="growth_identity"):
        cl.require(found)

    # it stays reported while nothing changes, and goes when its partition is mended
    assert check(spark, warehouse).failing == found.failing
    fault(spark, warehouse, "fct_events", "2024-01-12", lambda df: df.dropDuplicates(["event_id"]))
    mended = check(spark, warehouse)
    assert {n for n, _, _ in mended.failing} == {"growth_identity", "growth_segmented_identity"}

    # other accepted values: every partition is checked again
    other = cl.check_changed(spark, warehouse, ("share",))
    assert set(other.checked) == set(cl.CHECKED)
    assert ("stg_events_accepted_event_type", "error", spark.read.parquet(f"{warehouse}/stg_events").count()) in other.totals


def test_counts_equal_the_full_suite(spark, warehouse):
    """On a warehouse with faults of several kinds, totals are those of the checks over whole tables."""
    wh = scratch_path(spark, "faulty")
    for t in cl.CHECKED:
        df = spark.read.parquet(refresh.table_path(warehouse, t))
        if t == "dim_users":
            df = df.filter("user_id <> 'b'").withColumn("first_event_time_utc", F.expr(
                "CASE WHEN user_id = 'a' THEN first_event_time_utc + INTERVAL 1 DAY ELSE first_event_time_utc END"))
        if t == "fct_cohort_retention_triangle":
            df = df.withColumn("retention_rate", F.col("retention_rate") * 2)
        if t == "stg_events":
            df = df.withColumn("platform", F.lit("tv"))
        if t == "fct_growth_accounting":
            df = df.withColumn("churned_users", F.col("churned_users") + 1)
        sinks.replace(df, refresh.table_path(wh, t), refresh.LAYOUT[t][0])
    got = {n: k for n, _, k in check(spark, wh).totals}
    read = {t: refresh.read_table(spark, wh, t) for t in cl.CHECKED}
    g, fct, dim = read["fct_growth_accounting"], read["fct_events"], read["dim_users"]
    assert got["growth_segmented_prior_identity"] == dq.growth_prior_identity(g).count() > 0
    assert got["growth_prior_identity"] == dq.growth_prior_identity(g, True).count() > 0
    assert got["fct_events_relationship_user_id"] == fct.filter("user_id = 'b'").count()
    assert got["triangle_bounds"] == dq.triangle_bounds(read["fct_cohort_retention_triangle"]).count() > 0
    assert got["stg_events_accepted_platform"] == read["stg_events"].count()
    assert got["dim_first_event"] > 0 and dq.dim_first_event(dim, fct).count() == 1
    assert got["day_base_matches_fact"] == 0
