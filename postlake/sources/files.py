"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
             schema: StructType | str | None = None) -> DataFrame:
    """CSV with an optional header row.  Without ``schema`` every column is a
    string (no inference pass over the data)."""
    reader = spark.read.format("csv").option("header", str(header).lower()).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def topic_path(root: str, topic: str, partition: int | str = "*") -> str:
    """``<root>/<topic>/partition=<p>/*.json`` (all partitions by default)."""
    return f"{root.rstrip('/')}/{topic}/partition={partition}/*.json"


def read_topic(spark: SparkSession, root: str, topic: str, schema: StructType | None = None,
               partition: int | str = "*", corrupt_record: str | None = None) -> DataFrame:
    """JSON-lines files of one topic, as a sink connector lays them out.

    Pass the declared schema: without it Spark infers one with an extra pass
    over every file (and sorts the columns by name), which is fine for a look
    at a sample and wasteful at scale.  A line that does not parse is a row of
    NULLs; with ``corrupt_record`` a column of that name holds its text.
    """
    reader = spark.read.format("json")
    if corrupt_record is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_record)
        if schema is not None:
            schema = StructType([*schema.fields, StructField(corrupt_record, StringType())])
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(topic_path(root, topic, partition))


def write_lookup(df: DataFrame, path: str, key_col: str, row_group_bytes: int = 8 << 20,
                 distinct_keys: int | None = None) -> None:
    """Write a table that is looked up by ``key_col``.

    Rows are range-sorted by the key, so a key's rows lie in one or two files and
    the statistics of a row group cover a short range; each row group has a
    Parquet Bloom filter on the key, which rules out most that the range does
    not (``distinct_keys`` sizes it, if known).  :func:`lookup_value` on the
    table then reads the row groups that may hold the key.
    """
    writer = df.repartitionByRange(key_col).sortWithinPartitions(key_col).write.mode("overwrite") \
        .option("parquet.block.size", str(row_group_bytes)).option(f"parquet.bloom.filter.enabled#{key_col}", "true")
    if distinct_keys is not None:
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key_col}", str(distinct_keys))
    writer.parquet(path)


def lookup_value(df: DataFrame, key_col: str, key, value_col: str) -> DataFrame:
    """The ``value_col`` of the first row whose ``key_col`` equals ``key``
    (zero or one row).  The filter reaches the scan."""
    return df.where(F.col(key_col) == F.lit(key)).select(value_col).limit(1)


def single_value(df: DataFrame, key_col: str, key, value_col: str):
    """Driver-side scalar for configuration lookups; raises ``LookupError``
    when no row matches.  Only one row ever reaches the driver."""
    rows = lookup_value(df, key_col, key, value_col).take(1)
    if not rows:
        raise LookupError(f"no row with {key_col} = {key!r}")
    return rows[0][0]
