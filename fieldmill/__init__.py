"""Feature preparation and model data on Spark DataFrames."""

__version__ = "0.1.0"
