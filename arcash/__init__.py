"""arcash: receivables clean-up, collection forecast and cash schedule on Spark DataFrames."""

__version__ = "0.1.0"
