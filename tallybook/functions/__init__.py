"""Column helpers: contract casts, portable rounding, text keys."""
