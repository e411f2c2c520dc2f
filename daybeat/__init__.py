"""Wearable-health analytics as plain Spark DataFrame code."""
