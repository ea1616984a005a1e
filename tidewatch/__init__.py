"""Follow topics in community posts and comments with Spark DataFrames."""

__version__ = "0.1.0"
