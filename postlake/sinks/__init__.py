"""Writers: topic directories, views, and append-only tables."""

from postlake.sinks.files import register_views, write_topic

__all__ = ["register_views", "write_topic"]
