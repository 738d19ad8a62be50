"""Incremental upkeep of the daily series."""
