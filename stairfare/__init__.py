"""Fare-ladder analytics as Spark DataFrame jobs."""
