"""JDBC source for the three relational source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int | None = None,
              properties: dict | None = None, fetch_size: int = 10000) -> DataFrame:
    """A table over JDBC, read in parallel ranges of ``column``.

    With ``column``/``lower``/``upper``/``partitions`` Spark issues one query
    per stride of ``column`` so executors read concurrently; the bounds only
    shape the strides, no row is filtered out.  Credentials go in
    ``properties`` (``user``, ``password``), never in the URL.
    """
    props = {"fetchsize": str(fetch_size), **(properties or {})}
    if column is None:
        return spark.read.jdbc(url, table, properties=props)
    if lower is None or upper is None or partitions is None:
        raise ValueError("column needs lower, upper and partitions")
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=props)
