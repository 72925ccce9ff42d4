"""lendmart: lending analytics as Spark jobs."""
