"""Table-level operators: enrichment, roll-ups, windows, joins, retention, quality, alerts."""
