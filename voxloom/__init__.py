"""Dataset curation and voice-data analytics on Spark DataFrames."""
