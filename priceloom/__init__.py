"""Price analytics over repeated full snapshots, as Spark DataFrame jobs."""
