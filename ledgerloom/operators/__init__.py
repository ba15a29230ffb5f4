"""DataFrame operators: history, changes, windows, joins, aggregates, audits."""
