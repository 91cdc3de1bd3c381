"""Power-meter telemetry on Spark: clean, deduplicate, roll up, check and read."""
