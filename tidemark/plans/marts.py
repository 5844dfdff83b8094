"""Lazy wiring of the model DAG over one raw event DataFrame.

  raw -> stg_events -> dim_users -> fct_events -> user_day_segments
      -> user_period_segments -> activity -> growth / retention / engagement

Nothing here runs a job: every attribute is a DataFrame plan. Persisting a
node (``materialize``) is the caller's choice (see ``plans.refresh``).
"""
from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame

from ..functions import GRAINS
from ..operators import activity as act
from ..operators.core import dim_users, fct_events
from ..operators.engagement import engagement_depth
from ..operators.growth import growth_accounting, growth_dense
from ..operators.retention import cohort_retention_triangle
from ..operators.staging import stg_events
from ..params import RunParams


@dataclass
class Marts:
    raw: DataFrame
    params: RunParams = field(default_factory=RunParams)
    grains: tuple[str, ...] = GRAINS

    @cached_property
    def stg_events(self) -> DataFrame:
        return stg_events(self.raw, self.params)

    @cached_property
    def dim_users(self) -> DataFrame:
        return dim_users(self.stg_events, self.params)

    @cached_property
    def fct_events(self) -> DataFrame:
        return fct_events(self.stg_events, self.params)

    @cached_property
    def user_day_segments(self) -> DataFrame:
        return act.user_day_segments(self.fct_events)

    @cached_property
    def user_period_segments(self) -> DataFrame:
        return act.user_period_segments(self.user_day_segments, self.grains)

    @cached_property
    def activity(self) -> DataFrame:
        """Classified activity on full history (internal columns kept)."""
        return act.classify(self.user_period_segments)

    @cached_property
    def user_period_activity(self) -> DataFrame:
        return act.user_period_activity(self.activity, upto=self.params.cutoff_date())

    @cached_property
    def growth_accounting(self) -> DataFrame:
        return growth_accounting(self.activity, upto=self.params.cutoff_date())

    @cached_property
    def growth_dense(self) -> DataFrame:
        """Growth accounting with a row for every period of a segment."""
        return growth_dense(self.activity, upto=self.params.cutoff_date())

    @cached_property
    def cohort_retention_triangle(self) -> DataFrame:
        return cohort_retention_triangle(self.activity, upto=self.params.cutoff_date())

    @cached_property
    def engagement_depth(self) -> DataFrame:
        return engagement_depth(self.user_period_segments, self.params.power_user_min_events,
                                upto=self.params.cutoff_date())
