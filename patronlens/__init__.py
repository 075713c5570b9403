"""Customer-profile analytics as Spark DataFrame jobs."""
