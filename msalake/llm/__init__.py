"""Operators for training-data corpora: deduplication, sanitising, extraction, decontamination, scoring, formatting, mixing."""
