"""Orders and documents refined into data products, as plain Spark jobs."""
