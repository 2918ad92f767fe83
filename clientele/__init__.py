"""clientele: customer analytics on Spark DataFrames."""
