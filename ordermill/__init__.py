"""Order and sales analytics on Spark."""
