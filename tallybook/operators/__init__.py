"""Relational building blocks that hold under skew: ordered numbering, rules, key checks."""
