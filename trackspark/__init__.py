"""Genome-browser track data as PySpark DataFrame jobs."""
