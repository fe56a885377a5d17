"""Pipelines that chain operators and write tables."""
