"""Document analytics and table queries on Spark DataFrames."""
