"""tidemark: change-stream analytics as PySpark DataFrame and Structured Streaming programs."""
