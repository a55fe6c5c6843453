"""Market-bar analytics as Spark DataFrame transformations."""
