"""adlake: advertising performance analytics on Spark DataFrames."""
