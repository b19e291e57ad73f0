"""Sales-opportunity analytics as plain Spark DataFrame plans."""
