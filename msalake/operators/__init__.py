"""Keyed DataFrame operators; every one takes and returns DataFrames with a leading key column."""
