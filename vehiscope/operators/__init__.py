"""Single-purpose DataFrame operators (cleaning, dedupe, expansion,
aggregation, joins, ranking, stage audit)."""
