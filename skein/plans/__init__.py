"""Whole pipelines as compositions of operators."""
