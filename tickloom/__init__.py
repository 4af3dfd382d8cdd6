"""Market-data analytics as Spark jobs."""
