"""starhouse: a retail star-schema lakehouse built from Spark DataFrame operators.

Layers:
  sources/    bronze schemas, CSV batch reader, driver-table fixtures
  functions/  column expressions (text standardisation, change hash, money, calendar)
  operators/  DataFrame -> DataFrame transforms (silver, SCD2, dense keys, gold, quality, audit)
  sinks/      writers: versioned publish, idempotent append, partitioned fact, star tables
  streaming/  incremental ingest of dated transaction batches with Structured Streaming
  plans/      end-to-end jobs and the registered queries
"""

__version__ = "0.1.0"
