"""DuckDB SQL for the queries of ``loading``: which interval or delivery an event
belongs to follows from its time alone."""
from __future__ import annotations

from .oracle import _LOADED, _with, ORACLE_SQL, chain

ORACLE_SQL.update({
    "interval_ingest": _with(chain()[:3], """
  SELECT *, CASE WHEN event_time_utc <= TIMESTAMP '2024-01-08 00:00:00' THEN 1
    WHEN event_time_utc <= TIMESTAMP '2024-01-15 12:00:00' THEN 2
    WHEN event_time_utc <= TIMESTAMP '2024-01-22 00:00:00' THEN 3 ELSE 4 END AS interval_no
  FROM stg"""),
    "file_loads": _with(chain()[:3], f"""
  SELECT * REPLACE ({_LOADED} AS loaded_at), CASE WHEN event_time_utc < TIMESTAMP '2024-01-10 00:00:00' THEN 'd1'
    WHEN event_time_utc < TIMESTAMP '2024-01-20 00:00:00' THEN 'd2' ELSE 'd3' END AS delivery
  FROM stg"""),
})

from .checks_oracle import _counts  # noqa: E402
from .oracle import _KEPT, GROWTH, RAW_EVENTS, chain_over  # noqa: E402

_UPTO = "TIMESTAMP '2024-01-15 12:00:00'"
_EARLIER = "TIMESTAMP '2024-01-12 10:00:00'"
_ENDED = "(SELECT max(event_time_utc) FROM stg WHERE event_time_utc <= TIMESTAMP '2024-01-22 00:00:00')"


def _stale(at: str) -> str:
    """One failing row for each rule: loaded (here: happened) too long ago, and newest event too old."""
    return (f"FROM (SELECT unnest([1, 2]) AS days) WHERE TIMESTAMP '{at}' - {_ENDED} > days * INTERVAL 1 DAY")


ORACLE_SQL["dq_freshness"] = _with(chain()[:3], _counts([
    ("stale_at_once", _stale("2024-01-22 00:00:00")),
    ("stale_later", _stale("2024-01-23 12:00:00")),
    ("stale_much_later", _stale("2024-01-31 00:00:00")),
    ("beyond_cutoff", f"FROM stg WHERE event_time_utc > {_UPTO} AND event_time_utc <= {_UPTO}"),
    ("beyond_earlier", f"FROM (SELECT DISTINCT event_date_utc FROM stg WHERE event_time_utc <= {_UPTO} AND event_date_utc > DATE '2024-01-12' "
                       f"UNION ALL SELECT event_date_utc FROM stg WHERE event_date_utc = DATE '2024-01-12' AND event_time_utc > {_EARLIER})"),
]))

_ALL_ZERO = """activity_accepted cohort_retention_triangle_accepted_cohort_grain cohort_retention_triangle_not_null day_base_matches_fact
  dim_first_event dim_users_not_null dim_users_unique_user_id dim_users_unique_user_sk engagement_bounds engagement_depth_accepted_period_grain
  engagement_depth_not_null fct_events_not_null fct_events_relationship_user_id fct_events_relationship_user_sk fct_events_unique_event_id
  growth_accounting_accepted_period_grain growth_accounting_not_null growth_non_negative growth_segmented_non_negative
  stg_events_accepted_platform stg_events_not_null stg_events_unique_event_id triangle_bounds triangle_unique user_period_activity_accepted_period_grain
  user_period_activity_not_null classification_exclusive growth_prior_identity growth_segmented_prior_identity""".split()[1:]
_TOPLINE = "country = 'all' AND platform = 'all' AND utm_source = 'all'"

ORACLE_SQL["dq_changed_partitions"] = _with(
    [("raw_all", RAW_EVENTS)] + chain_over(_KEPT), _counts([(n, "FROM stg WHERE false") for n in _ALL_ZERO] + [
        ("stg_events_not_null_country", "FROM stg WHERE country IS NULL"),
        ("stg_events_accepted_event_type", "FROM stg WHERE event_type NOT IN ('click', 'error', 'purchase', 'signup')"),
        ("growth_identity", f"FROM growth WHERE period_start = DATE '2024-01-08' AND {_TOPLINE}"),
        ("growth_segmented_identity", "FROM growth WHERE period_start = DATE '2024-01-08'"),
    ]))
