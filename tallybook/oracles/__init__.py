"""ANSI SQL statements that recompute every registered query independently."""
