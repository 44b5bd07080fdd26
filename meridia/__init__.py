"""Evidence analytics as lazy Spark DataFrame queries."""
