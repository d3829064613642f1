"""Daily climate observations in a three-zone data lake, expressed as Spark DataFrames."""
