"""DataFrame operators: aggregates, windows, sequence windows, hierarchy, quality, joins."""
