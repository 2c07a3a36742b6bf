"""lakeweave — lakehouse analytics jobs expressed as Spark DataFrame plans.

Layout
------
sources/    driver-table readers, family fixtures, JSON/HTML extraction, sinks
functions/  column-level helpers (lenient casts, labels, classifiers)
operators/  DataFrame-level operators Spark lacks as one call
            (global ranks, exact quantiles, priority joins, uptime, data quality)
plans/      the composed jobs per family plus their DuckDB oracle SQL
streaming/  incremental ingest with Structured Streaming + foreachBatch
"""

__version__ = "0.1.0"
