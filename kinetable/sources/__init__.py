"""Readers and writers: text lines, Parquet, JSON, CSV, fitted pipelines."""
