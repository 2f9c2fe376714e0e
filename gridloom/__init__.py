"""Spreadsheet archives to long facts, and roll-ups of job metrics, as Spark jobs."""
