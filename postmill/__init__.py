"""Postmill: job-postings analytics expressed as Spark DataFrame jobs."""
