"""tagmill: tag curation, catalog reconciliation and multi-label evaluation on Spark DataFrames."""

__version__ = "0.1.0"
