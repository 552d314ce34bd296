"""Scans: Parquet tables, CSV, text logs, named source registry."""
