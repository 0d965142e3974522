"""Scans and sinks: parquet tables, rating text files, JSON reports."""
