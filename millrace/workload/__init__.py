"""Queries over the driver tables, each with an independent SQL statement where SQL can say it."""
