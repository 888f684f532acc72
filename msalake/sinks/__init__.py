"""Exports: FASTA, Stockholm / A3M, delimited, JSON and species lists."""
