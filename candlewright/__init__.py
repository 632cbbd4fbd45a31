"""Market time-series analytics expressed as PySpark DataFrame and streaming jobs."""
