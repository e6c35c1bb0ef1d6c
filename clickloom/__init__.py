"""clickloom: clickstream ingestion, cleaning, sessionization and marts on Spark."""

from clickloom.session import build_session, configure

__all__ = ["build_session", "configure"]
