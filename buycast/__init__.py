"""Purchase prediction on order-line tables, written as Spark DataFrame jobs."""
