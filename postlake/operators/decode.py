"""Record payloads: decode JSON payloads into rows, serialise rows back into
records, and unpack the two envelope shapes producers send."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType


# How producers write a timestamp (fixed format): wall clock, seconds, no zone.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
_JSON_TIMES = {"timestampFormat": TIME_FORMAT, "timestampNTZFormat": TIME_FORMAT}


def decode(df: DataFrame, schema: StructType, payload: str = "data",
           drop_malformed: bool = False) -> DataFrame:
    """Parse a JSON payload column (binary or string) with a fixed schema.

    The payload is cast to string first, so byte payloads from a stream work.
    A record that does not parse becomes an all-NULL row (kept, as upstream
    does) unless ``drop_malformed``; a field with a bad value is NULL alone.
    """
    parsed = df.select(F.from_json(F.col(payload).cast("string"), schema).alias("_json")).select("_json.*")
    if drop_malformed:
        parsed = parsed.where(reduce(lambda a, b: a | b, [F.col(f.name).isNotNull() for f in schema.fields]))
    return parsed


def to_records(df: DataFrame, ignore_null_fields: bool = True) -> DataFrame:
    """One JSON object per row in a ``value`` string column.

    NULL fields are left out unless ``ignore_null_fields=False``; timestamps
    are written as text in ``TIME_FORMAT``.
    """
    opts = {"ignoreNullFields": str(ignore_null_fields).lower(), **_JSON_TIMES}
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), opts).alias("value"))


def wrap_records(df: DataFrame) -> DataFrame:
    """Rows as REST-proxy payloads ``{"records":[{"value":{...}}]}``, one per row."""
    record = F.struct(F.struct(*[F.col(c) for c in df.columns]).alias("value"))
    return df.select(F.to_json(F.struct(F.array(record).alias("records")), _JSON_TIMES).alias("value"))


def wrap_data(df: DataFrame, stream_name: str = "stream", partition_key: str = "key") -> DataFrame:
    """Rows as stream-proxy payloads ``{"StreamName":…,"Data":{...},"PartitionKey":…}``."""
    body = F.struct(F.lit(stream_name).alias("StreamName"),
                    F.struct(*[F.col(c) for c in df.columns]).alias("Data"),
                    F.lit(partition_key).alias("PartitionKey"))
    return df.select(F.to_json(body, _JSON_TIMES).alias("value"))


def unpack_envelope(df: DataFrame, schema: StructType, kind: str = "records",
                    payload: str = "value") -> DataFrame:
    """Inverse of :func:`wrap_records` / :func:`wrap_data`: payload -> rows.

    ``records`` envelopes may carry many records each; every one becomes a row.
    """
    text = F.col(payload).cast("string")
    if kind == "records":
        env = StructType([StructField("records", ArrayType(
            StructType([StructField("value", schema, True)])), True)])
        return (df.select(F.from_json(text, env).alias("_env"))
                  .select(F.inline("_env.records"))
                  .select("value.*"))
    if kind == "data":
        env = StructType([StructField("StreamName", StringType(), True),
                          StructField("Data", schema, True),
                          StructField("PartitionKey", StringType(), True)])
        return df.select(F.from_json(text, env).alias("_env")).select("_env.Data.*")
    raise ValueError(f"unknown envelope kind {kind!r}; use 'records' or 'data'")
