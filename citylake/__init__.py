"""citylake: city-sensor analytics as Spark DataFrame jobs."""
