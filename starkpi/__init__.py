"""starkpi: retail star-schema KPIs as Spark DataFrame plans.

Layout:
  sources/    star schema readers/writers, CSV/Parquet/JSON I/O, table status
  functions/  column expressions: money and ratio rules, calendar, pricing, formats
  operators/  cleaning, data-quality checks, filters, distributed ordered ops
  plans/      KPI views, trends, dashboard/explorer queries, ETL, layout, export
  streaming/  incremental ingest and live KPIs with Structured Streaming
"""

from starkpi.sources.star import Star
from starkpi.operators.filters import SalesFilter

__all__ = ["Star", "SalesFilter"]
