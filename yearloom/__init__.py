"""Annual (entity, year, measure) panels on Spark."""
