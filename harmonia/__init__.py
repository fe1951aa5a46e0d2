"""harmonia: clinical data harmonisation as plain Spark DataFrame jobs.

Layout
  functions/  Column -> Column expressions (names, de-identification, dates, text, codes)
  operators/  DataFrame -> DataFrame operators (derived tables, merge, schema inference, quality)
  sources/    file manifest, checksums, row counts, ledgers, data dictionary, SQL scripts
  plans/      the per-source cleaner specifications and the stage functions that run them
  streaming/  incremental ingest of a raw folder with Structured Streaming
"""

__version__ = "0.1.0"
