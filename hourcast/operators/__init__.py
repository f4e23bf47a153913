"""Relational operators over hourly series (windows, joins, aggregates, stats, sinks, models)."""
