"""Structured Streaming wrappers over the batch operators."""

from .distil_stream import distil_stream, latest_scores, score_stream

__all__ = ["distil_stream", "latest_scores", "score_stream"]
