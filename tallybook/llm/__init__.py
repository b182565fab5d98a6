"""Operators for training-data pipelines.  Nothing outside this package (and the corpus pipeline) imports it."""
