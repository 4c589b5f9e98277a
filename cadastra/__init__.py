"""Land-record analytics on Spark: every operator is a function from DataFrame to DataFrame."""

__version__ = "0.1.0"
