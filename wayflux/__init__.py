"""wayflux: human-movement and case-count analytics as lazy Spark DataFrame operators."""
