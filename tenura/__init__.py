"""People-retention analytics as plain Spark DataFrame operators."""
