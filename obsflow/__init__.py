"""Station-observation analytics on PySpark: DataFrames, Spark ML and Structured Streaming."""
