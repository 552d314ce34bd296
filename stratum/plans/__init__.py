"""Composed plans: layers, medallion, query catalogue, audit trail, model registry."""
