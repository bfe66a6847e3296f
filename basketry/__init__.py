"""Customer analytics for marketplace orders, expressed as Spark DataFrame plans."""
