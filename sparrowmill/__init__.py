"""Sparrowmill: analytics operators, pipelines and benchmark queries for PySpark."""

from sparrowmill.session import build_session

__all__ = ["build_session"]
