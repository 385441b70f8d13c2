"""pitchside: match-event analytics as Spark DataFrame functions.

Layout
------
functions/  column expressions (metrics, key formatting, event flags)
sources/    readers: parquet tables, raw JSON match files, object listings
operators/  standardisation, staging, marts, reports, data quality, joins
sinks/      partitioned parquet, quarantine, JSON export
plans/      composed jobs: ingest batch, manifest verification, pipeline
streaming/  Structured Streaming ingest and dead-letter alarm
"""

__version__ = "0.1.0"
