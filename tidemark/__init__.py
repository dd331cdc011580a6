"""Point-in-time features and training sets for event data, on Spark DataFrames."""

__version__ = "0.1.0"
