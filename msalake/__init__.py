"""Sequence-alignment tables as Spark DataFrames: resolve, assemble, sample, score, expand, validate."""
