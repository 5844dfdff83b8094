"""Text normalisation used by staging."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import sqlexpr as sx

_EDGE_WS = r"^\s+|\s+$"


def trim_ws(c: Column) -> Column:
    """Strip leading/trailing whitespace of any kind (tabs, newlines too)."""
    return F.regexp_replace(c.cast("string"), _EDGE_WS, "")


def clean_text(c: Column | str, case: str | None = None) -> Column:
    """trim -> blank becomes null -> optional 'lower' / 'upper'."""
    if isinstance(c, str):
        return F.expr(sx.clean_text(c, case))
    out = F.nullif(trim_ws(c), F.lit(""))
    if case == "lower":
        out = F.lower(out)
    elif case == "upper":
        out = F.upper(out)
    return out
