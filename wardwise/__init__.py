"""Clinical-encounter analytics expressed as Spark DataFrame operators."""
