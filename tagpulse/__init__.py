"""tagpulse: tag popularity analytics as Spark DataFrame, SQL and Structured Streaming jobs."""
