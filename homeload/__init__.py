"""homeload: household-energy scenario data and run logs, as Spark DataFrame jobs."""
