"""gridclime: climate zoning of many places on Spark DataFrames."""
