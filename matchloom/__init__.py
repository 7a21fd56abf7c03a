"""Team-match telemetry analytics written as Spark DataFrame operators."""
