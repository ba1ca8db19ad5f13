"""Telemetry analytics on Spark: ingest, reshape, query, reduce and check fleet telemetry with DataFrames."""
