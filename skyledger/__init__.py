"""On-time-performance analytics for flight records, expressed as Spark DataFrame jobs."""
