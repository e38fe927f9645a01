"""Scans, snapshot freshness and sinks."""
