"""Semantic search over short text segments, built from Spark DataFrames."""

__version__ = "0.1.0"
