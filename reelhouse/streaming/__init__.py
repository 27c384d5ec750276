"""Incremental ingestion with Structured Streaming."""

from reelhouse.streaming.ratings_feed import PENDING, merge_ratings, release_pending, start_ratings_feed  # noqa: F401
