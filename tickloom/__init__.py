"""tickloom: market-data features on Spark DataFrames."""
