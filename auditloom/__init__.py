"""Risk review of payment transactions as Spark jobs."""
