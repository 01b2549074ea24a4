"""eddyflow: word counts and order metrics over bounded tables and streams,
built on Spark DataFrames and Structured Streaming."""

__version__ = "0.1.0"
