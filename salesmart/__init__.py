"""salesmart: retail sales analytics as distributed Spark DataFrame plans."""
