"""fareflow: trip-record analytics as composable Spark DataFrame operators."""
