"""Incremental form of the daily append."""
