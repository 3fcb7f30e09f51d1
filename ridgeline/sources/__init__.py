"""Readers and writers (Parquet, CSV, JSON) for the library's tables."""
