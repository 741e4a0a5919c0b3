"""telescry: network-telemetry analytics expressed as Spark DataFrame jobs."""
