"""Relational operators over DataFrames: as-of and interval joins, windows, aggregates, identity, models."""
