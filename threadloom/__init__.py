"""Forum participation analytics expressed as Spark DataFrame jobs."""
