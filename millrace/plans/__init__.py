"""Compositions of operators: model comparison, tuning, and the logistics example."""
