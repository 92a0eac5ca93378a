"""E-commerce offer analytics as PySpark DataFrame jobs."""

from offerwell.session import spark_session

__all__ = ["spark_session"]
