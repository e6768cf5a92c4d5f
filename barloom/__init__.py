"""barloom: end-of-day market data operators as Spark DataFrame functions."""

from barloom.session import build_session

__all__ = ["build_session"]
