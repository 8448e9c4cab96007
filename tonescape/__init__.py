"""Text sentiment and topic analytics on Spark DataFrames."""
