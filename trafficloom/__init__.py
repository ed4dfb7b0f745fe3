"""Traffic analytics operators for Spark DataFrames and streams."""
