"""cartscope — Spark-native e-commerce order analytics.

Nested JSON order payloads are read as VARIANT, normalised with native column
expressions into two typed tables (``orders``, one row per order, and
``order_items``, one row per purchased product), loaded idempotently and
reconciled, and a fixed library of dashboard metrics is answered as
Catalyst-optimised DataFrame plans.

Layout
------
- ``cartscope.functions``  column-expression helpers (coercion, text, calendar, rounding)
- ``cartscope.sources``    payload / staging / warehouse readers and the test-data adapter
- ``cartscope.operators``  flatten (lenient / raw + rejects), validation, skew-safe sequencing
- ``cartscope.sinks``      landing, staging and warehouse writers, table DDL
- ``cartscope.plans``      metric library (overview, KPIs, dashboard series, insights), ETL runner
- ``cartscope.streaming``  incremental ingest of landed payload files
"""

from cartscope.session import get_spark, work_root

__all__ = ["get_spark", "work_root"]
