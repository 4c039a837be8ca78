"""costloom: cloud-billing cost allocation as Spark DataFrame jobs."""
