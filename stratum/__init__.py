"""stratum: medallion-style batch analytics on Spark DataFrames and SQL.

Subpackages: ``sources`` (scans), ``functions`` (column expressions),
``operators`` (aggregates, windows, sequence windows, hierarchy, quality, joins),
``plans`` (layers, marts, query catalogue, audit, models) and ``streaming``.
"""

from .session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
