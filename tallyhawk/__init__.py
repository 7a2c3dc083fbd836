"""Payment-transaction analytics as Spark DataFrame operators."""
