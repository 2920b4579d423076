"""Health-insurance claims analytics expressed as Spark DataFrame jobs."""
