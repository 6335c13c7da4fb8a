"""Event-stream cleaning and reporting on Spark DataFrames and Structured Streaming."""
