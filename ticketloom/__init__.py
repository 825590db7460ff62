"""Support-ticket operations analytics as Spark DataFrame jobs."""
