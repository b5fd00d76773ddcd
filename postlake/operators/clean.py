"""Cleaning pipelines for posts, geolocation and users.

Each is one projection over the raw frame (a single ``select``), so batch and
streaming frames share the code and Catalyst collapses it into the scan's
whole-stage-codegen stage.  Column order and types follow
:mod:`postlake.schemas`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.functions import (POST_SENTINELS, expand_suffix, full_name, null_if_in,
                                strip_prefix, to_ts, tolerant_int)
from postlake.functions.udfs import parse_follower_count_udf
from postlake.schemas import CLEAN_GEO, CLEAN_POSTS, CLEAN_USERS, columns


def clean_posts(raw: DataFrame, use_udf: bool = False) -> DataFrame:
    """Sentinels and ``''`` to NULL, follower count to int, save-location
    prefix removed, ``index`` renamed to ``ind``.

    Three stacked projections, each referring to the previous one's columns,
    so Catalyst keeps them apart instead of inlining the sentinel test into
    every use inside the follower-count parser; all three run in one
    whole-stage-codegen span.
    """
    texts = {name: null_if_in(name, sentinel, "") for name, sentinel in POST_SENTINELS.items()}
    texts["save_location"] = strip_prefix("save_location")
    texts["ind"] = F.col("index").try_cast("bigint")
    names = columns(CLEAN_POSTS)
    step1 = raw.select(*[texts.get(name, F.col(name)).alias(name) for name in names])
    if use_udf:
        return step1.withColumn("follower_count", parse_follower_count_udf("follower_count"))
    step2 = step1.withColumn("follower_count", expand_suffix("follower_count"))
    return step2.withColumn("follower_count", tolerant_int("follower_count"))


def clean_geo(raw: DataFrame) -> DataFrame:
    """Latitude and longitude into ``coordinates`` (latitude first), timestamp
    parsed."""
    return raw.select(
        F.col("ind").try_cast("bigint").alias("ind"),
        F.col("country"),
        F.array(F.col("latitude").try_cast("double"), F.col("longitude").try_cast("double")).alias("coordinates"),
        to_ts("timestamp").alias("timestamp"),
    )


def clean_users(raw: DataFrame) -> DataFrame:
    """First and last name joined into ``user_name``, ``date_joined`` parsed."""
    return raw.select(
        F.col("ind").try_cast("bigint").alias("ind"),
        full_name("first_name", "last_name").alias("user_name"),
        F.col("age").try_cast("int").alias("age"),
        to_ts("date_joined").alias("date_joined"),
    )


CLEANERS = {"posts": clean_posts, "geo": clean_geo, "users": clean_users}

assert columns(CLEAN_GEO) == ["ind", "country", "coordinates", "timestamp"]
assert columns(CLEAN_USERS) == ["ind", "user_name", "age", "date_joined"]
