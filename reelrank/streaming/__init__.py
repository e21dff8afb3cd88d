"""Structured Streaming: rating messages → re-ranked recommendations per user."""

from .recommender import recommend_batch, start_stream  # noqa: F401
