"""Parquet tables by snapshot, and physical layouts for lookups."""
