"""Streaming use of the row-local operators."""

from .scoring import score_stream, write_available_now

__all__ = ["score_stream", "write_available_now"]
