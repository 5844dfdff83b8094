"""SQL-text builders for the hot expressions.

Each returns Spark SQL expression text over column *names*; operators pass
whole projections to ``selectExpr`` so the driver builds a plan with one
round trip per output column instead of one per expression node. The
Column-returning helpers in the sibling modules wrap the same text.
"""
from __future__ import annotations

# Fixed canonical formats of the key contract.
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
KEY_SEPARATOR = "|"
EDGE_WHITESPACE = r"^\\s+|\\s+$"   # SQL literal text; the parser unescapes \\s -> \s


def q(name: str) -> str:
    """Quote an identifier unless it is already an expression."""
    return name if not name.isidentifier() else f"`{name}`"


def clean_text(col: str, case: str | None = None) -> str:
    e = f"nullif(regexp_replace(CAST({q(col)} AS STRING), '{EDGE_WHITESPACE}', ''), '')"
    return f"{case}({e})" if case in ("lower", "upper") else e


def surrogate_key(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS STRING), '')" for e in exprs)
    return f"md5(concat_ws('{KEY_SEPARATOR}', {parts}))"


def ts_text(col: str) -> str:
    return f"date_format({q(col)}, '{TS_TEXT_FORMAT}')"


def event_key(time: str, user: str, event_type: str, miles: str, platform: str) -> str:
    return surrogate_key(ts_text(time), q(user), q(event_type),
                         f"CAST({q(miles)} AS DECIMAL(38,9))", q(platform))


def _dispatch(grain: str, daily: str, weekly: str, monthly: str) -> str:
    return (f"CASE {q(grain)} WHEN 'daily' THEN {daily} WHEN 'weekly' THEN {weekly} "
            f"WHEN 'monthly' THEN {monthly} END")


def period_start_for(grain: str, d: str) -> str:
    """Static grain (Python string) -> expression over date column ``d``."""
    return {"daily": q(d), "weekly": f"trunc({q(d)}, 'week')",
            "monthly": f"trunc({q(d)}, 'month')"}[grain]


def period_start(grain: str, d: str) -> str:
    return _dispatch(grain, q(d), f"trunc({q(d)}, 'week')", f"trunc({q(d)}, 'month')")


def prior_period_start(grain: str, p: str) -> str:
    return _dispatch(grain, f"date_sub({q(p)}, 1)", f"date_sub({q(p)}, 7)", f"add_months({q(p)}, -1)")


def next_period_start(grain: str, p: str) -> str:
    return _dispatch(grain, f"date_add({q(p)}, 1)", f"date_add({q(p)}, 7)", f"add_months({q(p)}, 1)")


def period_index(grain: str, cohort: str, activity: str) -> str:
    days = f"datediff({q(activity)}, {q(cohort)})"
    months = (f"((year({q(activity)}) - year({q(cohort)})) * 12 "
              f"+ (month({q(activity)}) - month({q(cohort)})))")
    return f"CAST({_dispatch(grain, days, f'floor({days} / 7)', months)} AS BIGINT)"


def ntz_literal(ts) -> str:
    """A zone-less timestamp literal (the engine's UTC wall-clock type)."""
    return f"TIMESTAMP_NTZ '{ts.isoformat(sep=' ')}'"
