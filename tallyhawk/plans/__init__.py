"""Compositions of operators: transform, load, the daily run, and the query registry."""
