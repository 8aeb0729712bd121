"""Reusable DataFrame operators: dedup, fills, masks/samples, joins,
aggregates, distributed ranking, top-k."""
