"""jobmart: job-market analytics as PySpark DataFrame, SQL and Structured Streaming jobs."""

__version__ = "0.1.0"
