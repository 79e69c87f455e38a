"""Point-in-time market-data operators on Spark DataFrames."""
