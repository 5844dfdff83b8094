"""Column-level helpers: every function returns a ``pyspark.sql.Column`` built
from built-in expressions, so it stays inside whole-stage codegen. The SQL
text builders behind the hot projections live in ``sqlexpr``."""
from . import sqlexpr
from .keys import event_key, surrogate_key, ts_text
from .literals import ts_ntz
from .periods import (GRAINS, next_period_start, period_index, period_start, period_start_for,
                      prior_period_start)
from .text import clean_text, trim_ws

__all__ = ["sqlexpr", "ts_ntz", "surrogate_key", "event_key", "ts_text", "trim_ws", "clean_text", "GRAINS",
           "period_start", "period_start_for", "prior_period_start", "next_period_start",
           "period_index"]
