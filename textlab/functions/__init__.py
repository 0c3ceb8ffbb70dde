"""Column expressions: no shuffle, no Python per row, usable on batches and streams."""
