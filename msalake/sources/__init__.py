"""Scans. Each reader is a thin ``spark.read`` call over a parser that also takes any DataFrame of text."""
