"""Structured Streaming: record sources, the three cleaning streams, and the
append-only table sink."""

from postlake.streaming.streams import (append_stream, read_stream, start_clean_stream, stream_geo,
                                       stream_posts, stream_users)

__all__ = ["append_stream", "read_stream", "start_clean_stream", "stream_geo", "stream_posts",
           "stream_users"]
