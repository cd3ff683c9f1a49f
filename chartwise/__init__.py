"""chartwise: daily ranking-chart analytics as plain Spark DataFrame functions.

Layers:
  functions/  column expressions (casts, text labels, market lookups)
  sources/    readers/writers: raw CSV, result TSV, Parquet + catalog table, test fixture
  operators/  DataFrame -> DataFrame steps (ingest filters, cleaning, top-k, gates)
  plans/      the user-level jobs: three questions, chart series, end-to-end run
  streaming/  incremental (file-stream) cleaning of newly landed raw files
"""

from chartwise.schema import (  # noqa: F401
    CHART_COLUMNS,
    RAW_COLUMNS,
    IngestConfig,
    Market,
    REFERENCE_MARKETS,
)

__all__ = ["CHART_COLUMNS", "RAW_COLUMNS", "IngestConfig", "Market", "REFERENCE_MARKETS"]
