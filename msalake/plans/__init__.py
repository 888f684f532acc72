"""Composed jobs over whole tables of targets."""
