"""Relational steps: checks, filters, joins, aggregates, order, labels, splits."""
