"""Raw and clean schemas shared by the batch and the streaming paths.

Raw timestamps stay strings, exactly as they travel in the JSON records; the
cleaning step parses them, so batch and stream run one transform.  ``ind`` /
``index`` are 64-bit so large row offsets never overflow, and coordinates are
doubles in both paths so batch and stream agree digit for digit.
"""

from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType,
                               TimestampNTZType)


def _struct(*fields):
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


RAW_POSTS = _struct(
    ("index", LongType()),
    ("unique_id", StringType()),
    ("title", StringType()),
    ("description", StringType()),
    ("poster_name", StringType()),
    ("follower_count", StringType()),
    ("tag_list", StringType()),
    ("is_image_or_video", StringType()),
    ("image_src", StringType()),
    ("downloaded", IntegerType()),
    ("save_location", StringType()),
    ("category", StringType()),
)

RAW_GEO = _struct(
    ("ind", LongType()),
    ("timestamp", StringType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
    ("country", StringType()),
)

RAW_USERS = _struct(
    ("ind", LongType()),
    ("first_name", StringType()),
    ("last_name", StringType()),
    ("age", IntegerType()),
    ("date_joined", StringType()),
)

CLEAN_POSTS = _struct(
    ("ind", LongType()),
    ("unique_id", StringType()),
    ("title", StringType()),
    ("description", StringType()),
    ("follower_count", IntegerType()),
    ("poster_name", StringType()),
    ("tag_list", StringType()),
    ("is_image_or_video", StringType()),
    ("image_src", StringType()),
    ("save_location", StringType()),
    ("category", StringType()),
)

CLEAN_GEO = _struct(
    ("ind", LongType()),
    ("country", StringType()),
    ("coordinates", ArrayType(DoubleType())),
    ("timestamp", TimestampNTZType()),
)

CLEAN_USERS = _struct(
    ("ind", LongType()),
    ("user_name", StringType()),
    ("age", IntegerType()),
    ("date_joined", TimestampNTZType()),
)

RAW = {"posts": RAW_POSTS, "geo": RAW_GEO, "users": RAW_USERS}
CLEAN = {"posts": CLEAN_POSTS, "geo": CLEAN_GEO, "users": CLEAN_USERS}


def columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields]
