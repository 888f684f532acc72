"""Column expressions and ordered / skew-safe DataFrame building blocks."""
