"""Operators on DataFrames: dedup, checks, contracts, publishing, incremental loads."""
