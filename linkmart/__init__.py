"""linkmart: paged JSON records to tested star-schema tables, as Spark DataFrame operators.

Layout:
  functions/  Column-level helpers (JSON access, URL tails, dates, keys)
  sources/    landing and reading page files, versioned Parquet tables, testbed frames
  operators/  DataFrame operators (record split, upsert, SCD2, staging, links, marts,
              dead letters, checks, extraction state)
  plans/      entity specs and the refresh job that chains the operators
  streaming/  file-stream ingestion with foreachBatch
"""

__version__ = "0.1.0"
