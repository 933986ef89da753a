"""Scans, incremental merges, contracts and sinks."""
