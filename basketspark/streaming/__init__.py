"""Structured Streaming form of the click-cleaning step (the job itself is batch)."""

from basketspark.streaming.clicks_stream import earlier_clicks, merge_clicks, start_clicks_stream

__all__ = ["earlier_clicks", "merge_clicks", "start_clicks_stream"]
