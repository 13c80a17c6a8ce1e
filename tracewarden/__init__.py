"""Security-telemetry analytics as Spark DataFrame jobs."""
