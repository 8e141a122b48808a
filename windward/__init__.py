"""Sailing-performance analytics as plain DataFrame-to-DataFrame Spark jobs."""
