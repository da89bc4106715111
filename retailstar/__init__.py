"""retailstar: a retail sales warehouse toolkit on Spark DataFrames."""

__version__ = "0.1.0"
