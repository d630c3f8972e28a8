"""Candidate screening, ranking and audit as Spark DataFrame jobs."""
