"""Launch-monitor analytics as Spark DataFrame jobs."""
