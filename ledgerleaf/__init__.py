"""Filing sections and corpus preparation as Spark jobs."""
