"""Scans: landed payloads, driver test tables, the feature table."""
