"""lakeshelf: retail lakehouse operators expressed as PySpark DataFrame plans.

Layers:
  sources/    batch and streaming scans, lineage columns, message decode, calendar
  sinks/      overwrite, dynamic partition overwrite, stream append, foreachBatch, compaction
  functions/  column-level helpers (parsing, JSON flattening, null-safe compare, hashing)
  operators/  table operators: dedup, upsert / delete / SCD2, rolling windows, quality rules
  plans/      silver cleaning, dimensions and facts built from the operators
  streaming/  incremental bronze ingest and micro-batch silver apply
  checks/     the query registry compared against DuckDB
"""

__version__ = "0.1.0"
