"""Batch-inference data jobs as Spark DataFrame and Structured Streaming operators."""

from reqframe.session import build_session, configure

__all__ = ["build_session", "configure"]
