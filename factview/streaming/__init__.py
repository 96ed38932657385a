"""Streams of facts: a publication for each micro-batch of new files."""

from factview.streaming.feed import publish_stream

__all__ = ["publish_stream"]
