"""Table quality, preparation and distributed learning operators for Spark DataFrames."""

__version__ = "0.1.0"
