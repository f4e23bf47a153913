"""Composed jobs (backfill, hourly append, training, scoring, EDA) and the
query catalog used by the driver contract."""
