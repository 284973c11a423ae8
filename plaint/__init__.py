"""Complaint-ticket analytics as Spark jobs."""
