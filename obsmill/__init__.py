"""Surface observation analytics on Spark."""
