"""Factory-line event analytics as Spark DataFrame and Structured Streaming jobs."""
