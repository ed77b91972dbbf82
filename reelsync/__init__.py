"""reelsync: keep nested search documents in step with relational tables,
expressed as Spark DataFrame jobs."""

__version__ = "0.1.0"
