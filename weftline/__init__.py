"""weftline: incremental web-corpus engine on Spark DataFrames."""

__version__ = "0.1.0"
