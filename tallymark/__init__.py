"""Sales, rental and visitor analytics expressed as Spark DataFrame plans."""
