"""Point-in-time feature analytics expressed as Spark DataFrame plans."""
