"""tidemark: product-growth analytics over event data, expressed as Spark DataFrame plans.

Layers:
  functions/  Column-level helpers (keys, text cleaning, period arithmetic).
  sources/    Readers: validated CSV ingest, Parquet tables, fixture adapters.
  operators/  DataFrame -> DataFrame transforms (staging, dimension, fact,
              period activity, growth accounting, retention, engagement,
              reporting, data-quality checks).
  plans/      Storage-touching orchestration: upsert / partition-overwrite sinks,
              watermarks, incremental and full-refresh runs.
  streaming/  Structured Streaming ingest that feeds the same upsert sinks.
"""

__version__ = "0.1.0"

from .params import RunParams  # noqa: E402
from .plans.marts import Marts  # noqa: E402
from .plans.refresh import refresh_all, refresh_events, refresh_periods  # noqa: E402
from .session import build_session  # noqa: E402

__all__ = ["RunParams", "Marts", "refresh_all", "refresh_events", "refresh_periods", "build_session"]
