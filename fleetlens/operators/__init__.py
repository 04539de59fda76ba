"""Relational operators (filters, joins, aggregates, windows) used by the
report plans, each a thin composition of DataFrame built-ins."""
