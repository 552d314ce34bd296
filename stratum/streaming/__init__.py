"""Incremental (available-now) file ingestion."""
