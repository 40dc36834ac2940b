"""Operators for training-data pipelines (each in its own module; see queries.py)."""
