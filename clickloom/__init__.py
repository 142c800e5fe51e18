"""Marketing-funnel analytics on Spark DataFrames."""
