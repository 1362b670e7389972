"""Daily-bar analytics as plain Spark DataFrame functions."""
