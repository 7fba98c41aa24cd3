"""Publication analytics and corpus preparation expressed as Spark DataFrame transformations."""
