"""Matching of records that arrive over time."""
