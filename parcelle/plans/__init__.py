"""Whole pipelines put together from operators and column functions."""
