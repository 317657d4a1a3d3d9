"""Card-payment fraud analytics written as Spark DataFrame jobs."""
