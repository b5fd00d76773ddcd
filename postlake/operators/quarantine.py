"""Record payloads checked and routed in one pass: good rows to one table,
records that cannot be read to another, each with the reason.

The checks are projections of built-in functions, the same for batch and stream.
One write (``partitionBy``) makes both tables, so the input is read and parsed
once; counts by reason are observed on the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

#: Why a record is set aside, in the order of the tests.
REASONS = ("empty", "not_json", "not_object", "bad_field", "no_key")
GOOD, BAD = "good", "quarantine"


def check_records(df: DataFrame, schema: StructType, payload: str = "data", key: str | None = None) -> DataFrame:
    """One row per record: ``row`` (the record with ``schema``'s fields; NULL if it
    is set aside), ``reason`` (NULL for good records), ``bad_fields`` and
    ``record`` (the payload as text; NULL for good records).

    ``empty``: NULL or blank payload.  ``not_json``: it does not parse.
    ``not_object``: JSON, but not an object.  ``bad_field``: a field that is
    there has a value its declared type cannot hold; ``bad_fields`` names all
    such, in declared order.  ``no_key``: the ``key`` field is missing or NULL.
    Unknown fields are ignored, declared fields that are missing are NULL.
    """
    text = F.col(payload).cast("string")
    corrupt = "__corrupt" + "_" * max(len(f.name) for f in schema.fields)  # longer than any field's name
    read = F.from_json(text, StructType([*schema.fields, StructField(corrupt, StringType())]),
                       {"columnNameOfCorruptRecord": corrupt})
    value = F.try_parse_json(text)
    parsed = df.select(text.alias("text"), read.alias("read"), value.alias("value"))
    torn = F.col("read").getField(corrupt).isNotNull()
    # a field is bad if it is there and not null, but the typed reading has nothing
    fields = F.try_variant_get("value", "$", "map<string,variant>")
    held = [F.col("fields")[f.name] for f in schema.fields]
    bad = F.array_compact(F.array(*[
        F.when(torn & h.isNotNull() & ~F.is_variant_null(h) & F.col("read").getField(f.name).isNull(), F.lit(f.name))
        for f, h in zip(schema.fields, held)]))
    looked = parsed.withColumn("fields", fields).select("text", "read", "value", bad.alias("bad_fields"))
    checks = [(F.col("text").isNull() | (F.btrim("text", F.lit(" \t\r\n")) == ""), "empty"),
              (torn & F.col("value").isNull(), "not_json"),
              (F.col("value").isNotNull() & ~F.schema_of_variant("value").startswith("OBJECT"), "not_object"),
              (torn | (F.size("bad_fields") > 0), "bad_field")]
    if key is not None:
        checks.append((F.col("read").getField(key).isNull(), "no_key"))
    reason: Column = F.lit(None).cast("string")
    for test, name in reversed(checks):
        reason = F.when(test, F.lit(name)).otherwise(reason)
    judged = looked.withColumn("reason", reason)
    row = F.struct(*[F.col("read").getField(f.name).alias(f.name) for f in schema.fields])
    good = F.col("reason").isNull()
    return judged.select(F.when(good, row).alias("row"), "reason",
                         F.when(F.col("reason") == "bad_field", F.col("bad_fields")).alias("bad_fields"),
                         F.when(~good, F.col("text")).alias("record"))


def _counts() -> list[Column]:
    """Records in all, good ones, and those of each reason."""
    return [F.count(F.lit(1)).alias("records"), F.count(F.when(F.col("reason").isNull(), 1)).alias(GOOD),
            *[F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in REASONS]]


def _routed(checked: DataFrame) -> DataFrame:
    return checked.withColumn("route", F.when(F.col("reason").isNull(), GOOD).otherwise(BAD))


def write_routed(checked: DataFrame, path: str) -> dict[str, int]:
    """Write both tables under ``path`` in one job; the counts of the pass."""
    seen = Observation()
    _routed(checked.observe(seen, *_counts())).write.mode("overwrite").partitionBy("route").parquet(path)
    return dict(seen.get)


def start_routed(checked: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                 name: str = "routed") -> StreamingQuery:
    """The same for a stream, appending.  Each progress report has the batch's
    counts under ``observedMetrics[name]``."""
    writer = (_routed(checked.observe(name, *_counts())).writeStream.format("parquet").outputMode("append")
              .partitionBy("route").option("path", path).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _read(spark: SparkSession, path: str, schema: StructType, route: str) -> DataFrame:
    fields = StructType([StructField("row", schema), StructField("reason", StringType()),
                         StructField("bad_fields", ArrayType(StringType())), StructField("record", StringType()),
                         StructField("route", StringType())])
    return spark.read.schema(fields).parquet(path).where(F.col("route") == route)


def read_good(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The good rows; the other table's files are not opened."""
    return _read(spark, path, schema, GOOD).select("row.*")


def read_quarantine(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """``record``, ``reason``, ``bad_fields``; the good rows' files are not opened."""
    return _read(spark, path, schema, BAD).select("record", "reason", "bad_fields")
