"""Daily market bars joined with developer activity, as Spark DataFrame jobs."""

__version__ = "0.1.0"
