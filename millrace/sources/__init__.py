"""Readers and writers: CSV, Parquet, fitted models."""
