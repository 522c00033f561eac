"""Two-source title catalogue analytics as plain Spark DataFrame jobs."""
