"""pagemill: web-document analytics on Spark DataFrames."""
