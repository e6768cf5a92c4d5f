"""Structured Streaming form of the daily load."""

from barloom.streaming.incremental import read_stream_rejects, stream_full_prices

__all__ = ["read_stream_rejects", "stream_full_prices"]
