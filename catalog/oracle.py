"""DuckDB oracle SQL for the registered queries.

Written from the metric definitions (set algebra over user sets per period),
not from the Spark plans: first periods come from GROUP BY + join, the
new/retained/resurrected split from EXISTS on the prior period, churn from
an anti-join of the prior period's users. Views ``events``, ``customer``,
``nation``, ``orders`` ... are provided by the caller.
"""
from __future__ import annotations


def _with(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


# Raw adapters (same shapes as tidemark.sources.adapters).
RAW_EVENTS = """
  SELECT e.ts AS event_time, e.user_id,
    CASE e.k % 4 WHEN 0 THEN 'F' WHEN 1 THEN ' M ' WHEN 2 THEN '' END AS gender,
    CASE WHEN e.k % 7 = 0 THEN ' ' || upper(e.event_type) || ' ' ELSE e.event_type END AS event_type,
    CASE WHEN e.event_type = 'purchase'
         THEN (CASE e.k % 3 WHEN 0 THEN 'Travel' WHEN 1 THEN 'dining ' ELSE '' END) END
      AS transaction_category,
    CASE WHEN e.event_type IN ('purchase', 'signup') THEN e.value END AS miles_amount,
    CASE e.k % 4 WHEN 0 THEN 'ios' WHEN 1 THEN ' Android' WHEN 2 THEN 'WEB' END AS platform,
    CASE e.k % 3 WHEN 0 THEN 'google' WHEN 1 THEN 'Organic ' END AS utm_source,
    CASE WHEN n.n_nationkey > 0 THEN lower(n.n_name) END AS country,
    e.ts AS loaded_at
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
  LEFT JOIN customer c ON c.c_custkey = e.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey"""

RAW_ORDERS = """
  SELECT o.o_orderdate AS event_time, o.o_custkey AS user_id, CAST(NULL AS VARCHAR) AS gender,
    'order' AS event_type, o.o_orderpriority AS transaction_category,
    o.o_totalprice AS miles_amount,
    CASE o.o_orderstatus WHEN 'F' THEN 'ios' WHEN 'O' THEN 'android' ELSE 'web' END AS platform,
    CAST(NULL AS VARCHAR) AS utm_source, c.c_mktsegment AS country, o.o_orderdate AS loaded_at
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey"""

_WS = "' \t\n\r'"


def _clean(col: str, case: str | None = None) -> str:
    e = f"NULLIF(trim(CAST({col} AS VARCHAR), {_WS}), '')"
    return f"{case}({e})" if case else e


STG_TYPED = f"""
  SELECT CAST(event_time AS TIMESTAMP) AS event_time_utc,
    CAST(user_id AS VARCHAR) AS user_id,
    {_clean('gender')} AS gender,
    {_clean('event_type', 'lower')} AS event_type,
    {_clean('transaction_category', 'lower')} AS transaction_category,
    CAST(miles_amount AS DECIMAL(38,9)) AS miles_amount,
    {_clean('platform', 'lower')} AS platform,
    {_clean('utm_source', 'lower')} AS utm_source,
    {_clean('country', 'upper')} AS country,
    CAST(loaded_at AS TIMESTAMP) AS loaded_at
  FROM raw"""

STG = """
  SELECT md5(coalesce(strftime(event_time_utc, '%Y-%m-%d %H:%M:%S.%f'), '') || '|' ||
             coalesce(user_id, '') || '|' || coalesce(event_type, '') || '|' ||
             coalesce(CAST(miles_amount AS VARCHAR), '') || '|' || coalesce(platform, '')) AS event_id,
    event_time_utc, user_id, gender, event_type, transaction_category, miles_amount,
    platform, utm_source, country,
    CAST(event_time_utc AS DATE) AS event_date_utc,
    CAST(date_trunc('week', event_time_utc) AS TIMESTAMP) AS event_week_utc,
    CAST(date_trunc('month', event_time_utc) AS TIMESTAMP) AS event_month_utc,
    loaded_at
  FROM typed
  WHERE user_id IS NOT NULL AND event_time_utc IS NOT NULL"""


def _latest(attr: str) -> str:
    # fixed-width time text then the 32-hex event id: lexical order = (time, id) order
    return (f"arg_max({attr}, strftime(event_time_utc, '%Y-%m-%d %H:%M:%S.%f') || event_id) "
            f"FILTER (WHERE {attr} IS NOT NULL) AS latest_{attr}")


DIM = f"""
  SELECT md5(coalesce(user_id, '')) AS user_sk, user_id,
    min(event_time_utc) AS first_event_time_utc,
    CAST(min(event_time_utc) AS DATE) AS first_event_date_utc,
    max(event_time_utc) AS latest_event_time_utc,
    CAST(max(event_time_utc) AS DATE) AS latest_event_date_utc,
    {_latest('gender')}, {_latest('platform')}, {_latest('country')}, {_latest('utm_source')}
  FROM stg GROUP BY user_id"""

FCT = """
  SELECT s.event_id, d.user_sk, s.user_id, s.event_time_utc, s.event_date_utc, s.event_week_utc,
    s.event_month_utc, s.event_type, s.transaction_category, s.miles_amount, s.gender,
    s.platform, s.utm_source, s.country, s.loaded_at
  FROM stg s LEFT JOIN dim d ON d.user_id = s.user_id"""

# user x period x segment, with per-period event counts; 'all' re-aggregates
# across segments for the same user.
def _ups_branch(grain: str, rollup: bool) -> str:
    period = {"daily": "event_date_utc",
              "weekly": "CAST(date_trunc('week', event_date_utc) AS DATE)",
              "monthly": "CAST(date_trunc('month', event_date_utc) AS DATE)"}[grain]
    seg = ("'all', 'all', 'all'" if rollup else
           "coalesce(country, 'UNKNOWN'), coalesce(platform, 'unknown'), coalesce(utm_source, 'unknown')")
    return (f"SELECT '{grain}' AS period_grain, {period} AS period_start, {seg}, user_id, "
            f"coalesce(miles_amount, CAST(0 AS DECIMAL(38,9))) AS m FROM fct")


# user x period x segment, with per-period event counts; 'all' re-aggregates
# across segments for the same user.
UPS = (
    "\n  SELECT period_grain, period_start, country, platform, utm_source, user_id,\n"
    "         CAST(count(*) AS BIGINT) AS event_count, sum(m) AS miles_sum\n"
    "  FROM (\n    "
    + "\n    UNION ALL\n    ".join(
        _ups_branch(g, r) for g in ("daily", "weekly", "monthly") for r in (False, True))
    + "\n  ) AS t (period_grain, period_start, country, platform, utm_source, user_id, m)\n"
    "  GROUP BY ALL")


def _prior(p: str) -> str:
    return (f"CASE period_grain WHEN 'daily' THEN CAST({p} - INTERVAL 1 DAY AS DATE) "
            f"WHEN 'weekly' THEN CAST({p} - INTERVAL 7 DAY AS DATE) "
            f"ELSE CAST({p} - INTERVAL 1 MONTH AS DATE) END")


FIRST = """
  SELECT period_grain, country, platform, utm_source, user_id, min(period_start) AS first_active_period
  FROM ups GROUP BY ALL"""

ACT = f"""
  SELECT u.period_grain, u.period_start, u.country, u.platform, u.utm_source, u.user_id,
    f.first_active_period,
    {_prior('u.period_start').replace('period_grain', 'u.period_grain')} AS prior_period_start,
    u.period_start = f.first_active_period AS is_new,
    u.period_start <> f.first_active_period AND NOT EXISTS (
      SELECT 1 FROM ups h WHERE h.period_grain = u.period_grain AND h.country = u.country
        AND h.platform = u.platform AND h.utm_source = u.utm_source AND h.user_id = u.user_id
        AND h.period_start = {_prior('u.period_start').replace('period_grain', 'u.period_grain')})
      AS is_resurrected,
    u.period_start <> f.first_active_period AND EXISTS (
      SELECT 1 FROM ups h WHERE h.period_grain = u.period_grain AND h.country = u.country
        AND h.platform = u.platform AND h.utm_source = u.utm_source AND h.user_id = u.user_id
        AND h.period_start = {_prior('u.period_start').replace('period_grain', 'u.period_grain')})
      AS is_retained
  FROM ups u JOIN first_active f USING (period_grain, country, platform, utm_source, user_id)"""

GROWTH = """
  SELECT a.period_grain, a.period_start, a.country, a.platform, a.utm_source,
    a.active_users, a.new_users, a.retained_users, a.resurrected_users,
    coalesce(c.churned_users, 0) AS churned_users
  FROM (
    SELECT period_grain, period_start, country, platform, utm_source,
      count(DISTINCT user_id) AS active_users,
      count(DISTINCT user_id) FILTER (WHERE is_new) AS new_users,
      count(DISTINCT user_id) FILTER (WHERE is_retained) AS retained_users,
      count(DISTINCT user_id) FILTER (WHERE is_resurrected) AS resurrected_users
    FROM act GROUP BY ALL) a
  LEFT JOIN (
    SELECT p.period_grain, p.period_start, p.country, p.platform, p.utm_source,
      count(DISTINCT prev.user_id) AS churned_users
    FROM (SELECT DISTINCT period_grain, period_start, country, platform, utm_source, prior_period_start
          FROM act) p
    JOIN act prev ON prev.period_grain = p.period_grain AND prev.period_start = p.prior_period_start
      AND prev.country = p.country AND prev.platform = p.platform AND prev.utm_source = p.utm_source
    WHERE NOT EXISTS (
      SELECT 1 FROM act cur WHERE cur.period_grain = p.period_grain
        AND cur.period_start = p.period_start AND cur.country = p.country
        AND cur.platform = p.platform AND cur.utm_source = p.utm_source
        AND cur.user_id = prev.user_id)
    GROUP BY ALL) c
  USING (period_grain, period_start, country, platform, utm_source)"""

TRIANGLE = """
  SELECT r.cohort_grain, r.cohort_start, r.activity_period_start, r.period_index,
    r.country, r.platform, r.utm_source, s.cohort_users, r.retained_users,
    r.retained_users / s.cohort_users AS retention_rate
  FROM (
    SELECT period_grain AS cohort_grain, first_active_period AS cohort_start,
      period_start AS activity_period_start,
      CAST(CASE period_grain
        WHEN 'daily' THEN date_diff('day', first_active_period, period_start)
        WHEN 'weekly' THEN date_diff('day', first_active_period, period_start) // 7
        ELSE date_diff('month', first_active_period, period_start) END AS BIGINT) AS period_index,
      country, platform, utm_source, count(DISTINCT user_id) AS retained_users
    FROM act GROUP BY ALL) r
  JOIN (
    SELECT period_grain AS cohort_grain, first_active_period AS cohort_start,
      country, platform, utm_source, count(DISTINCT user_id) AS cohort_users
    FROM first_active GROUP BY ALL) s
  USING (cohort_grain, cohort_start, country, platform, utm_source)
  WHERE r.period_index >= 0"""

ENGAGEMENT = """
  SELECT period_grain, period_start, country, platform, utm_source,
    CAST(sum(event_count) AS BIGINT) AS total_events,
    count(DISTINCT user_id) AS active_users,
    CAST(sum(event_count) AS DOUBLE) / count(DISTINCT user_id) AS events_per_active_user,
    CAST(sum(miles_sum) AS DOUBLE) / count(DISTINCT user_id) AS avg_miles_per_active_user,
    count(DISTINCT user_id) FILTER (WHERE event_count >= 3) AS power_users,
    CAST(count(DISTINCT user_id) FILTER (WHERE event_count >= 3) AS DOUBLE)
      / count(DISTINCT user_id) AS power_user_share
  FROM ups GROUP BY ALL"""


def chain(source: str = "events", upto: str | None = None) -> list[tuple[str, str]]:
    """CTEs raw -> typed -> stg -> dim -> fct -> ups -> first_active -> act."""
    raw = RAW_EVENTS if source == "events" else RAW_ORDERS
    return [("raw", raw), ("typed", STG_TYPED), ("stg", STG), ("dim", DIM), ("fct", FCT),
            ("ups", UPS), ("first_active", FIRST), ("act", ACT)]


def _topline(sql: str) -> str:
    return f"SELECT * FROM ({sql}) WHERE country = 'all' AND platform = 'all' AND utm_source = 'all'"


ORACLE_SQL: dict[str, str] = {
    "stg_events": _with(chain()[:3], "SELECT * FROM stg"),
    "dim_users": _with(chain()[:4], "SELECT * FROM dim"),
    "fct_events": _with(chain()[:5], "SELECT * FROM fct"),
    "user_period_segments": _with(chain()[:6], "SELECT * FROM ups"),
    "user_period_activity": _with(chain(), "SELECT * FROM act"),
    "growth_accounting": _with(chain(), GROWTH),
    "growth_topline": _with(chain(), _topline(GROWTH)),
    "growth_orders": _with(chain("orders"), GROWTH),
    "cohort_retention_triangle": _with(chain(), TRIANGLE),
    "engagement_depth": _with(chain()[:6], ENGAGEMENT),
}


CHURNED = """
  SELECT p.period_grain, p.period_start, p.country, p.platform, p.utm_source, prev.user_id
  FROM (SELECT DISTINCT period_grain, period_start, country, platform, utm_source, prior_period_start
        FROM act) p
  JOIN act prev ON prev.period_grain = p.period_grain AND prev.period_start = p.prior_period_start
    AND prev.country = p.country AND prev.platform = p.platform AND prev.utm_source = p.utm_source
  WHERE NOT EXISTS (
    SELECT 1 FROM act cur WHERE cur.period_grain = p.period_grain
      AND cur.period_start = p.period_start AND cur.country = p.country
      AND cur.platform = p.platform AND cur.utm_source = p.utm_source AND cur.user_id = prev.user_id)"""

COHORT_SIZES = """
  SELECT period_grain AS cohort_grain, first_active_period AS cohort_start, country, platform,
    utm_source, count(*) AS cohort_users
  FROM first_active GROUP BY ALL"""

POWER_USERS = """
  SELECT period_grain, period_start, country, platform, utm_source, user_id, event_count
  FROM ups WHERE event_count >= 3"""

SURROGATE = """
  SELECT event_id,
    md5(concat_ws('|', coalesce(strftime(event_time_utc, '%Y-%m-%d %H:%M:%S.%f'), ''),
        coalesce(user_id, ''), coalesce(event_type, ''), coalesce(CAST(miles_amount AS VARCHAR), ''),
        coalesce(platform, ''))) AS recomputed_event_id,
    md5(user_id) AS user_sk
  FROM stg"""

_METRICS = ["active_users", "new_users", "retained_users", "resurrected_users", "churned_users"]

LONG_FORM = " UNION ALL ".join(
    f"SELECT period_grain, period_start, '{m}' AS metric, {m} AS value FROM growth_top" for m in _METRICS)

SCORECARDS = ("SELECT period_grain, count(*) AS periods, min(period_start) AS first_period, "
              "max(period_start) AS last_period, "
              + ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in _METRICS)
              + " FROM growth_top GROUP BY period_grain")

MATRIX = ("SELECT cohort_grain, cohort_start, country, platform, utm_source, cohort_users, period_index, retention_rate"
          " FROM tri WHERE cohort_grain = 'monthly' AND country = 'all' AND platform = 'all' AND utm_source = 'all'")

ORACLE_SQL.update({
    "churned_users": _with(chain(), CHURNED),
    "cohort_sizes": _with(chain(), COHORT_SIZES),
    "power_users": _with(chain()[:6], POWER_USERS),
    "surrogate_key": _with(chain()[:3], SURROGATE),
    "growth_long_form": _with(chain() + [("growth_top", _topline(GROWTH))], LONG_FORM),
    "growth_scorecards": _with(chain() + [("growth_top", _topline(GROWTH))], SCORECARDS),
    "cohort_matrix": _with(chain("orders") + [("tri", TRIANGLE)], MATRIX),
})


# ----------------------------------------------------------------- data quality
def _counts(pairs: list[tuple[str, str]]) -> str:
    """UNION ALL of (check, failures) rows; each pair is (name, 'FROM ... WHERE ...')."""
    return "\nUNION ALL\n".join(f"SELECT '{n}' AS \"check\", count(*) AS failures {body}" for n, body in pairs)


def _dup(table: str, col: str) -> str:
    return (f"FROM (SELECT {col} FROM {table} WHERE {col} IS NOT NULL "
            f"GROUP BY {col} HAVING count(*) > 1)")


_REF_TYPES = "('miles_earned', 'miles_redeemed', 'like', 'share', 'reward_search')"
_ADAPTER_TYPES = "('click', 'error', 'purchase', 'signup', 'view')"
_GROWTH_CHAIN = chain() + [("growth", GROWTH)]
_TOP = "country = 'all' AND platform = 'all' AND utm_source = 'all'"


def _prior_identity(where: str) -> str:
    return (f"FROM growth c JOIN growth p ON p.period_grain = c.period_grain AND p.country = c.country "
            f"AND p.platform = c.platform AND p.utm_source = c.utm_source "
            f"AND p.period_start = {_prior('c.period_start').replace('period_grain', 'c.period_grain')} "
            f"WHERE {where} p.active_users <> c.retained_users + c.churned_users")


_NEG = " OR ".join(f"{m} < 0" for m in _METRICS)

ORACLE_SQL.update({
    "dq_not_null": _with(chain()[:5], _counts(
        [(f"stg_events_not_null_{c}", f"FROM stg WHERE {c} IS NULL")
         for c in ("event_id", "event_time_utc", "user_id", "event_type", "country")]
        + [(f"dim_users_not_null_{c}", f"FROM dim WHERE {c} IS NULL")
           for c in ("user_sk", "user_id", "first_event_time_utc")]
        + [(f"fct_events_not_null_{c}", f"FROM fct WHERE {c} IS NULL")
           for c in ("event_id", "user_sk", "user_id", "event_time_utc")])),
    "dq_unique": _with(chain()[:5], _counts([
        ("stg_events_unique_event_id", _dup("stg", "event_id")),
        ("dim_users_unique_user_sk", _dup("dim", "user_sk")),
        ("dim_users_unique_user_id", _dup("dim", "user_id")),
        ("fct_events_unique_event_id", _dup("fct", "event_id"))])),
    "dq_accepted_values": _with(chain() + [("growth", GROWTH), ("eng", ENGAGEMENT)], _counts([
        ("stg_events_event_type_reference_set", f"FROM stg WHERE event_type NOT IN {_REF_TYPES}"),
        ("stg_events_event_type_adapter_set", f"FROM stg WHERE event_type NOT IN {_ADAPTER_TYPES}"),
        ("stg_events_platform", "FROM stg WHERE platform NOT IN ('ios', 'android', 'web')"),
        ("growth_accounting_period_grain", "FROM growth WHERE period_grain NOT IN ('daily', 'weekly', 'monthly')"),
        ("engagement_depth_period_grain", "FROM eng WHERE period_grain NOT IN ('daily', 'weekly', 'monthly')")])),
    "dq_relationships": _with(chain()[:5], _counts([
        ("fct_events_user_sk", "FROM fct WHERE user_sk IS NOT NULL AND user_sk NOT IN (SELECT user_sk FROM dim WHERE user_sk IS NOT NULL)"),
        ("fct_events_user_id", "FROM fct WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM dim WHERE user_id IS NOT NULL)")])),
    "dq_source_availability": _with(chain()[:1], _counts([
        (f"source_availability_{d}",
         f"FROM (SELECT 1) WHERE (SELECT count(*) FROM raw WHERE CAST(event_time AS DATE) = DATE '{d}') = 0")
        for d in ("2024-01-15", "2024-02-15")])),
    "dq_source_duplicates": _with(chain()[:2], _counts([
        ("source_duplicates",
         "FROM (SELECT event_time_utc, user_id, event_type, miles_amount, platform FROM typed "
         "GROUP BY ALL HAVING count(*) > 1)")])),
    "dq_dim_first_event": _with(chain()[:5], _counts([
        ("dim_first_event", "FROM dim d JOIN (SELECT user_id, min(event_time_utc) AS m FROM fct GROUP BY user_id) e "
                            "USING (user_id) WHERE d.first_event_time_utc <> e.m")])),
    "dq_growth_identity": _with(_GROWTH_CHAIN, _counts([
        ("growth_identity", f"FROM growth WHERE {_TOP} AND active_users <> new_users + retained_users + resurrected_users"),
        ("growth_segmented_identity", "FROM growth WHERE active_users <> new_users + retained_users + resurrected_users")])),
    "dq_growth_prior_identity": _with(_GROWTH_CHAIN, _counts([
        ("growth_prior_identity", _prior_identity(f"c.{_TOP.replace(' AND ', ' AND c.')} AND")),
        ("growth_segmented_prior_identity", _prior_identity(""))])),
    "dq_growth_non_negative": _with(_GROWTH_CHAIN, _counts([
        ("growth_non_negative", f"FROM growth WHERE {_TOP} AND ({_NEG})"),
        ("growth_segmented_non_negative", f"FROM growth WHERE {_NEG}")])),
    "dq_classification_exclusive": _with(chain(), _counts([
        ("classification_exclusive",
         "FROM act WHERE CAST(is_new AS INT) + CAST(is_retained AS INT) + CAST(is_resurrected AS INT) > 1")])),
    "dq_triangle_bounds": _with(chain() + [("tri", TRIANGLE)], _counts([
        ("triangle_bounds", "FROM tri WHERE period_index < 0 OR cohort_users <= 0 OR retained_users < 0 "
                            "OR retained_users > cohort_users OR retention_rate < 0 OR retention_rate > 1")])),
    "dq_triangle_unique": _with(chain() + [("tri", TRIANGLE)], _counts([
        ("triangle_unique", "FROM (SELECT cohort_grain, cohort_start, activity_period_start, period_index, "
                            "country, platform, utm_source FROM tri GROUP BY ALL HAVING count(*) > 1)")])),
    "dq_engagement_bounds": _with(chain()[:6] + [("eng", ENGAGEMENT)], _counts([
        ("engagement_bounds", "FROM eng WHERE total_events < 0 OR active_users < 0 OR power_users < 0 "
                              "OR power_users > active_users OR events_per_active_user < 0 "
                              "OR avg_miles_per_active_user < 0 OR power_user_share < 0 OR power_user_share > 1")])),
})


# ----------------------------------------------------------------- incremental / cutoff / ingest
import re  # noqa: E402

_CTE_NAMES = ("raw", "typed", "stg", "dim", "fct", "ups", "first_active", "act", "growth")


def prefixed(ctes: list[tuple[str, str]], prefix: str) -> list[tuple[str, str]]:
    """Rename a CTE chain (names and references) with ``prefix``."""
    pat = re.compile(r"\b(" + "|".join(_CTE_NAMES) + r")\b(?=\s|$|\))")

    def fix(sql: str) -> str:
        return pat.sub(lambda m: prefix + m.group(1), sql)
    return [(prefix + n, fix(s)) for n, s in ctes]


def chain_over(raw_sql: str, prefix: str = "", upto: str | None = None) -> list[tuple[str, str]]:
    ctes = [("raw", raw_sql)] + chain()[1:]
    if upto:
        ctes.append(("growth", f"SELECT * FROM ({GROWTH}) WHERE period_start <= DATE '{upto[:10]}'"))
    else:
        ctes.append(("growth", GROWTH))
    return prefixed(ctes, prefix) if prefix else ctes


# Two-batch protocol: batch 1 holds events up to 2024-01-20 00:00 except the
# late ones (error events before that instant); batch 2 is everything.
_LATE = ("lower(trim(event_type)) = 'error' AND event_time < TIMESTAMP '2024-01-20 00:00:00'")
_B1 = f"SELECT * FROM raw_all WHERE event_time <= TIMESTAMP '2024-01-20 00:00:00' AND NOT ({_LATE})"
_WM = f"(SELECT max(event_time) FROM ({_B1}))"
_KEPT = f"SELECT * FROM raw_all WHERE NOT ({_LATE} AND event_time <= {_WM} - INTERVAL 1 DAY)"
_IGNORED = f"SELECT * FROM raw_all WHERE {_LATE} AND event_time <= {_WM} - INTERVAL 1 DAY"
_AFTER3 = f"(CAST({_WM} AS DATE) - INTERVAL 3 DAY)"

_LOADED = "TIMESTAMP '2024-06-01 00:00:00'"   # the load time that both ingest queries pass in

ORACLE_SQL.update({
    "user_day_segments": _with(chain()[:5], """
      SELECT event_date_utc AS activity_date, user_id, coalesce(country, 'UNKNOWN') AS country,
        coalesce(platform, 'unknown') AS platform, coalesce(utm_source, 'unknown') AS utm_source,
        count(*) AS event_count, coalesce(sum(miles_amount), CAST(0 AS DECIMAL(38,9))) AS miles_sum
      FROM fct GROUP BY ALL"""),
    "csv_ingest": _with(chain()[:3], f"SELECT * REPLACE ({_LOADED} AS loaded_at) FROM stg"),
    "stg_events_incremental": _with([("raw_all", RAW_EVENTS)] + chain_over(_KEPT)[:3], "SELECT * FROM stg"),
    "fct_events_incremental": _with([("raw_all", RAW_EVENTS)] + chain_over(_KEPT)[:5], "SELECT * FROM fct"),
    "dim_users_incremental": _with([("raw_all", RAW_EVENTS)] + chain_over(_KEPT)[:4], "SELECT * FROM dim"),
    "late_events_ignored": _with([("raw_all", RAW_EVENTS)] + chain_over(_IGNORED)[:3], "SELECT * FROM stg"),
    "growth_incremental": _with(
        [("raw_all", RAW_EVENTS)] + chain_over(_KEPT, "k_") + chain_over(_B1, "b_"),
        f"SELECT * FROM k_growth WHERE period_start > {_AFTER3} "
        f"UNION ALL SELECT * FROM b_growth WHERE period_start <= {_AFTER3}"),
    "growth_cutoff": _with(
        chain_over(RAW_EVENTS.replace("LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey",
                                      "LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey "
                                      "WHERE e.ts <= TIMESTAMP '2024-01-15 12:00:00'"),
                   upto="2024-01-15 12:00:00"),
        "SELECT * FROM growth"),
})

ORACLE_SQL["refresh_recovery"] = _with(
    [("raw_all", RAW_EVENTS)] + chain_over(_KEPT)[:5],
    "SELECT event_date_utc AS activity_date, count(*) AS events, count(DISTINCT user_id) AS users FROM fct GROUP BY ALL")
ORACLE_SQL["full_refresh"] = ORACLE_SQL["fct_events"]
ORACLE_SQL["streaming_ingest"] = _with([("raw_all", RAW_EVENTS)] + chain_over(_KEPT)[:5],
                                       f"SELECT * REPLACE ({_LOADED} AS loaded_at) FROM fct")
ORACLE_SQL["growth_dashboard"] = _with(chain(), GROWTH + "\n  ORDER BY period_grain, period_start")
ORACLE_SQL["cutoff_bounded_run"] = _with(
    chain_over(RAW_EVENTS.replace("LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey",
                                  "LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey "
                                  "WHERE e.ts <= TIMESTAMP '2024-01-15 12:00:00'"))[:5],
    "SELECT * FROM fct")
ORACLE_SQL["growth_orders_monthly"] = _with(
    chain("orders"), _topline(GROWTH) + " AND period_grain = 'monthly'")
ORACLE_SQL["growth_trend"] = _with(
    chain(), "SELECT period_start, " + ", ".join(_METRICS) + f" FROM ({_topline(GROWTH)}) "
    "WHERE period_grain = 'weekly' ORDER BY period_start")

_SEEDED_CHAIN = chain() + [("growth", GROWTH), ("tri", TRIANGLE), ("eng", ENGAGEMENT)]
ORACLE_SQL["dq_seeded_faults"] = _with(_SEEDED_CHAIN, _counts([
    ("unique_event_id", "FROM (SELECT event_id FROM stg WHERE event_type = 'purchase' GROUP BY event_id)"),
    ("source_duplicates", "FROM (SELECT event_time, user_id, miles_amount, platform FROM raw "
                          "WHERE event_type = 'purchase' GROUP BY ALL)"),
    ("relationships_user_id", "FROM fct WHERE user_id IN (SELECT user_id FROM dim WHERE latest_platform = 'ios')"),
    ("dim_first_event", "FROM dim WHERE latest_platform = 'web'"),
    ("growth_identity", "FROM growth WHERE period_grain = 'weekly'"),
    ("growth_prior_identity", "FROM growth c JOIN growth p ON p.period_grain = c.period_grain "
                              "AND p.country = c.country AND p.platform = c.platform AND p.utm_source = c.utm_source "
                              "AND p.period_start = CAST(c.period_start - INTERVAL 1 DAY AS DATE) "
                              "WHERE c.period_grain = 'daily'"),
    ("growth_non_negative", "FROM growth WHERE period_grain = 'daily'"),
    ("classification_exclusive", "FROM act WHERE is_new"),
    ("triangle_bounds", "FROM tri WHERE retention_rate * 2 > 1"),
    ("triangle_unique", "FROM (SELECT 1 FROM tri WHERE cohort_grain = 'monthly')"),
    ("engagement_bounds", "FROM eng WHERE period_grain = 'weekly'"),
]))

_STG_CHAIN = chain()[:3]
ORACLE_SQL["upsert_merge"] = _with(_STG_CHAIN, """
  SELECT event_id, event_time_utc, user_id, gender, event_type,
    CASE WHEN event_type = 'purchase' THEN 'corrected' ELSE transaction_category END AS transaction_category,
    miles_amount, platform, utm_source, country, event_date_utc, event_week_utc, event_month_utc, loaded_at
  FROM stg""")

_FIRST_HALF = RAW_EVENTS.replace("LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey",
                                 "LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey "
                                 "WHERE e.ts < TIMESTAMP '2024-01-15 00:00:00'")
ORACLE_SQL["partition_overwrite"] = _with(
    chain()[:6] + prefixed([("raw", _FIRST_HALF)] + chain()[1:6], "h_")
    + [("eng_all", ENGAGEMENT), ("eng_first", ENGAGEMENT.replace("FROM ups", "FROM h_ups"))],
    "SELECT * FROM eng_first WHERE period_start < DATE '2024-01-15' "
    "UNION ALL SELECT * FROM eng_all WHERE period_start >= DATE '2024-01-15'")

# Two batches, marts with a 3-day period lookback. The triangle's cells are
# rewritten from the earlier of that and the start of the first changed period.
_K_AND_B = [("raw_all", RAW_EVENTS)] + chain_over(_KEPT, "k_") + chain_over(_B1, "b_")


def _recent_else_first(sql: str, column: str = "period_start", after: str = _AFTER3) -> str:
    kept, first = (prefixed([("growth", sql)], p)[0][1] for p in ("k_", "b_"))
    return f"SELECT * FROM ({kept}) WHERE {column} > {after} UNION ALL SELECT * FROM ({first}) WHERE {column} <= {after}"


ORACLE_SQL["engagement_incremental"] = _with(_K_AND_B, _recent_else_first(ENGAGEMENT))
ORACLE_SQL["activity_incremental"] = _with(_K_AND_B, _recent_else_first("SELECT * FROM act"))
ORACLE_SQL["triangle_incremental"] = _with([("raw_all", RAW_EVENTS)] + chain_over(_KEPT), TRIANGLE)
ORACLE_SQL["growth_orders_since"] = _with(chain("orders"), f"SELECT * FROM ({GROWTH}) WHERE period_start > DATE '1998-03-01'")
