"""Readers for CSV, Parquet, catalog tables and views."""
