"""Document-processing operators on Spark DataFrames."""
