"""Column expressions: one value in, one value out, no shuffle."""
