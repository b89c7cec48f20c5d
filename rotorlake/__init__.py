"""Wind-turbine telemetry analytics as Spark DataFrame functions."""
