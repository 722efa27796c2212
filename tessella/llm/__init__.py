"""Operators for training-data pipelines over the synthetic corpus tables."""
