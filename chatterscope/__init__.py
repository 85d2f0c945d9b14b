"""Social-post analytics on PySpark DataFrames and Structured Streaming."""
