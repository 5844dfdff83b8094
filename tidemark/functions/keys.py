"""Deterministic surrogate keys: hex MD5 over '|'-joined canonical text.

Nulls become the empty string before joining, so (null, 'a') and ('', 'a')
share a key - the documented behaviour of the key contract.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from .sqlexpr import KEY_SEPARATOR, TS_TEXT_FORMAT  # fixed canonical text formats


def ts_text(c: Column) -> Column:
    """Timestamp -> fixed-width text with microseconds."""
    return F.date_format(c, TS_TEXT_FORMAT)


def surrogate_key(*cols: Column) -> Column:
    """md5 of the columns' text joined by '|' (nulls as '')."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def event_key(event_time: Column, user_id: Column, event_type: Column,
              miles_amount: Column, platform: Column) -> Column:
    """Event identity: time, user, type, miles (decimal text) and platform.

    Gender, category, utm source and country are deliberately not part of
    the identity; rows that differ only there collide (the duplicate-signature
    check reports them).
    """
    return surrogate_key(ts_text(event_time), user_id, event_type,
                         miles_amount.cast("decimal(38,9)"), platform)
