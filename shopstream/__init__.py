"""Retail analytics on Spark: logs and change records in, daily reports out."""

from shopstream.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
