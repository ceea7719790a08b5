"""Incremental form of the sales sync."""
