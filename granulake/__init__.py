"""granulake: satellite-product file metadata as Spark jobs."""
