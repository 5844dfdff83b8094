"""DuckDB SQL for the queries of ``checks``: distinct users counted from the
fact for each grain, gaps filled by joining with generated periods, medians and
deviations from lists of each window."""
from __future__ import annotations

from .oracle import _METRICS, _counts, _prior, _prior_identity, _with, ENGAGEMENT, GROWTH, ORACLE_SQL, chain

_NEXT = {g: f"CAST({{}} + INTERVAL {step} AS DATE)" for g, step in (("daily", "1 DAY"), ("weekly", "7 DAY"), ("monthly", "1 MONTH"))}
_SEGMENT = "period_grain, country, platform, utm_source"


def _next(p: str, grain: str = "period_grain") -> str:
    return "CASE " + grain + " " + " ".join(f"WHEN '{g}' THEN {e.format(p)}" for g, e in _NEXT.items()) + " END"


def _dense() -> list[tuple[str, str]]:
    """CTE ``dense`` over ``act``: generated periods, left-joined with counts."""
    spine = " UNION ALL ".join(
        f"SELECT {_SEGMENT}, CAST(unnest(generate_series(lo, least({e.format('hi')}, newest), INTERVAL {s})) AS DATE) AS period_start "
        f"FROM spans WHERE period_grain = '{g}'" for (g, e), s in zip(_NEXT.items(), ("1 DAY", "7 DAY", "1 MONTH")))
    return [
        ("spans", f"""
  SELECT {_SEGMENT}, min(period_start) AS lo, max(period_start) AS hi,
    (SELECT max(period_start) FROM act) AS newest
  FROM act GROUP BY ALL"""),
        ("spine", spine),
        ("present", f"""
  SELECT {_SEGMENT}, period_start, count(*) AS active_users, count(*) FILTER (is_new) AS new_users,
    count(*) FILTER (is_retained) AS retained_users, count(*) FILTER (is_resurrected) AS resurrected_users
  FROM act GROUP BY ALL"""),
        ("gone", f"""
  SELECT {', '.join('a.' + c.strip() for c in _SEGMENT.split(','))}, {_next('a.period_start', 'a.period_grain')} AS period_start, count(*) AS churned_users
  FROM act a LEFT JOIN act b ON b.user_id = a.user_id AND b.period_grain = a.period_grain AND b.country = a.country
    AND b.platform = a.platform AND b.utm_source = a.utm_source AND b.period_start = {_next('a.period_start', 'a.period_grain')}
  WHERE b.user_id IS NULL GROUP BY ALL"""),
        ("dense", f"""
  SELECT period_grain, period_start, country, platform, utm_source, {', '.join(f'coalesce({m}, 0) AS {m}' for m in _METRICS)}
  FROM spine LEFT JOIN present USING ({_SEGMENT}, period_start) LEFT JOIN gone USING ({_SEGMENT}, period_start)"""),
    ]


def _prior_on(table: str, churned: str) -> str:
    return _prior_identity("").replace("growth c", f"{table} c").replace("growth p", f"{table} p").replace("c.churned_users", churned)


def _gaps(where: str) -> str:
    return (f"FROM (SELECT *, lag(period_start) OVER (PARTITION BY {_SEGMENT} ORDER BY period_start) AS before FROM dense {where}) "
            f"WHERE before <> {_prior('period_start')}")


def _rates(churned: str) -> str:
    return (f"FROM dense c JOIN dense p ON p.period_grain = c.period_grain AND p.country = c.country AND p.platform = c.platform "
            f"AND p.utm_source = c.utm_source AND p.period_start = {_prior('c.period_start').replace('period_grain', 'c.period_grain')} "
            f"WHERE p.active_users > 0 AND (c.retained_users > p.active_users OR {churned} > p.active_users)")


ORACLE_SQL.update({
    "growth_dense": _with(chain() + _dense(), "SELECT * FROM dense"),
    "growth_dense_orders": _with(chain("orders") + _dense(), "SELECT * FROM dense"),
    "dq_growth_dense": _with(chain() + _dense(), _counts([
        ("dense_prior_identity", _prior_on("dense", "c.churned_users")),
        ("dense_gaps", _gaps("")),
        ("dense_rate_bounds", _rates("c.churned_users")),
        ("dense_gaps_without_empty_periods", _gaps("WHERE active_users > 0")),
        ("dense_prior_identity_seeded", _prior_on("dense", "c.churned_users + CAST(c.active_users = 0 AS INT)")),
        ("dense_rate_bounds_seeded", _rates("c.churned_users + CASE WHEN c.period_grain = 'weekly' THEN 1000000000 ELSE 0 END")),
    ])),
})

# ----------------------------------------------------------------- across grains
_DISTINCT = ("counted", """
  SELECT period_grain, period_start, country, platform, utm_source, count(DISTINCT user_id) AS d FROM ups GROUP BY ALL""")
_FAULTY = ("faulty", """
  SELECT period_grain, period_start, country, platform, utm_source,
    active_users + CASE WHEN period_grain = 'weekly' AND platform = 'ios' THEN 1 ELSE 0 END AS active_users
  FROM growth WHERE NOT (period_grain = 'monthly' AND country = 'all')""")
_BY_DAY = "\n  UNION ALL\n".join(
    f"""
  SELECT '{g}' AS period_grain, CAST(date_trunc('{unit}', period_start) AS DATE) AS period_start, country, platform, utm_source,
    sum(total_events) AS by_day
  FROM eng WHERE period_grain = 'daily' AND {{}} GROUP BY ALL""" for g, unit in (("weekly", "week"), ("monthly", "month")))


def _users(table: str, tolerance: float = 0.0, where: str = "true") -> str:
    return (f"FROM {table} g FULL JOIN counted c USING (period_grain, period_start, country, platform, utm_source) "
            f"WHERE abs(coalesce(g.active_users, 0) - coalesce(c.d, 0)) > {tolerance} * coalesce(c.d, 0) AND {where}")


def _totals(where: str) -> str:
    return (f"FROM (SELECT * FROM eng WHERE period_grain <> 'daily') e FULL JOIN ({_BY_DAY.format(where, where)}) d "
            "USING (period_grain, period_start, country, platform, utm_source) "
            "WHERE coalesce(e.total_events, 0) <> coalesce(d.by_day, 0)")


ORACLE_SQL["dq_cross_grain"] = _with(
    chain() + [("growth", GROWTH), ("eng", ENGAGEMENT), _DISTINCT, _FAULTY], _counts([
        ("users", _users("growth")),
        ("users_by_sketch", "FROM growth WHERE false"),
        ("users_seeded", _users("faulty")),
        ("users_seeded_5_percent", _users("faulty", 0.05)),
        ("users_seeded_settled", _users("faulty", where=f"{_next('period_start')} <= DATE '2024-01-20'")),
        ("totals", _totals("true")),
        ("totals_seeded", _totals("platform <> 'android'")),
    ]))

# ----------------------------------------------------------------- volume
_SEEDED = """
  SELECT event_date_utc AS day, coalesce(country, 'UNKNOWN') AS country, coalesce(platform, 'unknown') AS platform,
    CASE WHEN platform = 'ios' AND event_date_utc = DATE '2024-01-25' THEN 4 ELSE 1 END AS weight
  FROM fct WHERE event_date_utc <> DATE '2024-01-20'"""
_PLAIN = """
  SELECT event_date_utc AS day, coalesce(country, 'UNKNOWN') AS country, coalesce(platform, 'unknown') AS platform, 1 AS weight FROM fct"""


def _volume(source: str, p: str) -> list[tuple[str, str]]:
    return [
        (f"{p}e", source),
        (f"{p}by", f"""
  SELECT 'all' AS dimension, 'all' AS value, day, sum(weight) AS n FROM {p}e GROUP BY ALL
  UNION ALL SELECT 'platform', platform, day, sum(weight) FROM {p}e GROUP BY ALL
  UNION ALL SELECT 'country', country, day, sum(weight) FROM {p}e GROUP BY ALL"""),
        (f"{p}days", f"""
  SELECT s.dimension, s.value, CAST(d.day AS DATE) AS activity_date, coalesce(CAST(b.n AS BIGINT), 0) AS events
  FROM (SELECT DISTINCT dimension, value FROM {p}by) s
  CROSS JOIN (SELECT unnest(generate_series((SELECT min(day) FROM {p}e), (SELECT max(day) FROM {p}e), INTERVAL 1 DAY)) AS day) d
  LEFT JOIN {p}by b ON b.dimension = s.dimension AND b.value = s.value AND b.day = d.day"""),
        *[(f"{p}w{n}", f"""
  SELECT a.dimension, a.value, a.activity_date, a.events,
    CASE WHEN count(b.events) = {n} THEN median(b.events) END AS median_events
  FROM {p}days a LEFT JOIN {p}days b ON b.dimension = a.dimension AND b.value = a.value
    AND b.activity_date BETWEEN a.activity_date - INTERVAL {n} DAY AND a.activity_date - INTERVAL 1 DAY
  GROUP BY ALL""") for n in (7, 14)]]


ORACLE_SQL["volume_baseline"] = _with(chain()[:5] + _volume(_SEEDED, "s_"), "SELECT * FROM s_w7")
ORACLE_SQL["dq_volume"] = _with(chain()[:5] + _volume(_PLAIN, "p_") + _volume(_SEEDED, "s_"), _counts([
    (f"{name}_{n}_days_{d}", f"FROM {p}w{n} WHERE dimension = '{d}' AND median_events > 0 "
                             "AND (events * 100 < 40 * median_events OR events * 100 > 250 * median_events)")
    for name, p in (("volume", "p_"), ("volume_seeded", "s_")) for n in (7, 14) for d in ("all", "platform", "country")]))


# ----------------------------------------------------------------- spikes and dips
def _scores(dense: str, p: str) -> list[tuple[str, str]]:
    return [
        (f"{p}long", " UNION ALL ".join(
            f"SELECT period_grain, period_start, country, platform, utm_source, '{m}' AS metric, {m} AS value FROM {dense}" for m in _METRICS)),
        (f"{p}numbered", f"""
  SELECT *, CASE period_grain WHEN 'daily' THEN date_diff('day', DATE '1970-01-01', period_start)
    WHEN 'weekly' THEN date_diff('day', DATE '1970-01-05', period_start) // 7
    ELSE date_diff('month', DATE '1970-01-01', period_start) END AS i FROM {p}long"""),
        (f"{p}lists", f"""
  SELECT *, coalesce(list(value) OVER w, []) AS l, avg(value) OVER w AS mean, stddev_samp(value) OVER w AS deviation
  FROM {p}numbered WINDOW w AS (PARTITION BY {_SEGMENT}, metric ORDER BY i RANGE BETWEEN 14 PRECEDING AND 1 PRECEDING)"""),
        (f"{p}med", f"SELECT *, list_aggregate(l, 'median') AS median FROM {p}lists"),
        (f"{p}mad", f"SELECT *, list_aggregate(list_transform(l, lambda x: abs(x - median)), 'median') AS mad FROM {p}med"),
        (f"{p}flags", f"""
  SELECT *, len(l) >= 7 AND coalesce(abs(value - median) >= 5 AND abs(value - mean) > 3 * deviation, false) AS by_z,
    len(l) >= 7 AND coalesce(abs(value - median) >= 5 AND 0.6745 * abs(value - median) > 3.5 * mad, false) AS by_mad
  FROM {p}mad"""),
        (f"{p}scores", f"""
  SELECT period_grain, period_start, country, platform, utm_source, metric, value, CAST(len(l) AS BIGINT) AS periods_before,
    CASE WHEN len(l) >= 7 THEN median END AS median, CASE WHEN len(l) >= 7 THEN mad END AS mad,
    CASE WHEN len(l) >= 7 THEN mean END AS mean, CASE WHEN len(l) >= 7 THEN deviation END AS deviation, by_z, by_mad,
    CASE WHEN by_z OR by_mad THEN CASE WHEN value > median THEN 'spike' ELSE 'dip' END END AS kind
  FROM {p}flags""")]


_FAULTY_DENSE = ("faulty_dense", """
  SELECT * REPLACE (
    CASE WHEN period_grain = 'daily' AND period_start = DATE '2024-01-25' THEN retained_users * 10 ELSE retained_users END AS retained_users,
    CASE WHEN period_grain = 'daily' AND period_start = DATE '2024-01-20' THEN 0 ELSE active_users END AS active_users)
  FROM dense""")

ORACLE_SQL["metric_scores"] = _with(chain() + _dense() + _scores("dense", "n_"), "SELECT * FROM n_scores")
ORACLE_SQL["metric_anomalies_orders"] = _with(
    chain("orders") + _dense() + _scores("dense", "n_"), "SELECT * FROM n_scores WHERE by_z OR by_mad")
ORACLE_SQL["dq_metric_anomalies"] = _with(
    chain() + _dense() + [_FAULTY_DENSE] + _scores("dense", "n_") + _scores("faulty_dense", "s_"), _counts([
        (f"{name}_{m}_{k}", f"FROM {p}scores WHERE metric = '{m}' AND kind = '{k}'")
        for name, p in (("anomalies", "n_"), ("anomalies_seeded", "s_"))
        for m, k in (("active_users", "dip"), ("active_users", "spike"), ("retained_users", "spike"))]))

ORACLE_SQL["event_mix"] = _with(chain()[:5], " UNION ALL ".join(
    f"""
  SELECT '{g}' AS period_grain, period_start, event_type, events, events / sum(events) OVER (PARTITION BY period_start) AS share
  FROM (SELECT CAST(date_trunc('{unit}', event_time_utc) AS DATE) AS period_start, event_type, count(*) AS events FROM fct GROUP BY ALL)"""
    for g, unit in (("daily", "day"), ("weekly", "week"), ("monthly", "month"))))
