"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from postlake.schemas import CLEAN, columns

# Fixed names the SQL questions use for the clean tables.
VIEW_NAMES = {"posts": "posts", "geo": "countries", "users": "users"}


def write_topic(df: DataFrame, root: str, topic: str, partition: int = 0,
                mode: str = "append") -> str:
    """Rows as JSON lines under ``<root>/<topic>/partition=<n>/``, the layout a
    topic-to-object-store connector produces.  Returns the directory."""
    path = f"{root.rstrip('/')}/{topic}/partition={partition}"
    df.write.mode(mode).json(path)
    return path


def register_views(posts: DataFrame, geo: DataFrame, users: DataFrame) -> None:
    """Name the clean tables ``posts``, ``countries`` and ``users`` for SQL, with
    their own columns only (the lake's layout adds one to two of them)."""
    for name, df in (("posts", posts), ("geo", geo), ("users", users)):
        df.select(*columns(CLEAN[name])).createOrReplaceTempView(VIEW_NAMES[name])
