"""Candidate models: Spark ML estimators and aggregate-based models under one small interface.

``fit(df)`` takes columns features (vector), label, weight and returns a
function that adds ``prediction`` and, for classifiers, ``score``.
"""
