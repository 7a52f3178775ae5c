"""Readers and writers: driver parquet tables, run-log artifacts, sinks."""
