"""Operators over whole tables: filters, joins, aggregates, similarity, topics."""
