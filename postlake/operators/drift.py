"""How the records of a topic differ from the schema declared for them.

Payloads are parsed to VARIANT, so a field may have a different type in every
record.  Every record is compared with the declared ``StructType`` in one
distributed pass, and the differences are counted by name and type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, ShortType, StringType, StructType)

#: JSON types that a declared type reads without loss (fixed mapping).
_WHOLE, _NUMBER = ("BIGINT",), ("BIGINT", "DECIMAL", "DOUBLE")
_FITS: dict[type[DataType], tuple[str, ...]] = {
    StringType: ("STRING",), BooleanType: ("BOOLEAN",), ByteType: _WHOLE, ShortType: _WHOLE, IntegerType: _WHOLE,
    LongType: _WHOLE, FloatType: _NUMBER, DoubleType: _NUMBER, DecimalType: _NUMBER}


def _objects(records: DataFrame, payload: str) -> DataFrame:
    """Each object's fields as a map of variants.  Payloads that are no JSON
    object, or repeat a name, are left out."""
    return records.select(F.try_parse_json(F.col(payload).cast("string")).alias("v")) \
        .where(F.schema_of_variant("v").startswith("OBJECT")) \
        .select(F.variant_get("v", "$", "map<string,variant>").alias("m"))


def _entries(m: Column) -> Column:
    """``[{field, type}]``; OBJECT<…>, ARRAY<…> and DECIMAL(…) by their names,
    a null as VOID."""
    return F.transform(F.map_entries(m), lambda e: F.struct(
        e["key"].alias("field"), F.regexp_extract(F.schema_of_variant(e["value"]), r"^[A-Z]+", 0).alias("type")))


def _counted(entries: DataFrame, *by: str) -> DataFrame:
    return entries.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def field_types(records: DataFrame, payload: str = "value") -> DataFrame:
    """``(field, type, n)``: in how many records each top-level field has a JSON
    type (``VOID`` is null)."""
    each = _objects(records, payload).select(F.explode(_entries(F.col("m"))).alias("e")).select("e.*")
    return _counted(each, "field", "type")


def schema_drift(records: DataFrame, declared: StructType, payload: str = "value") -> DataFrame:
    """``(field, status, found, n)``: ``added`` (a field that is not declared),
    ``retyped`` (its values cannot be read with the declared type; one row for
    each JSON type found) and ``missing`` (declared, but not in ``n`` records or
    null there; ``found`` is NULL).  Each record is compared where it lies, so
    only differences are shuffled; a topic that fits its schema gives no rows."""
    names = [f.name for f in declared.fields]
    fits = F.create_map(*[x for f in declared.fields for x in
                          (F.lit(f.name), F.array(*[F.lit(t) for t in _FITS.get(type(f.dataType), ())]).cast("array<string>"))])
    absent = F.filter(F.array(*map(F.lit, names)), lambda d: F.col("m")[d].isNull() | F.is_variant_null(F.col("m")[d]))
    status = F.when(~F.col("field").isin(names), "added").when(
        (F.col("type") != "VOID") & ~F.array_contains(fits[F.col("field")], F.col("type")), "retyped")
    objects = _objects(records, payload)
    there = F.transform(_entries(F.col("m")), lambda e: F.struct(e["field"].alias("field"), e["type"].alias("type"), F.lit(False).alias("gone")))
    gone = F.transform(absent, lambda d: F.struct(d.alias("field"), F.lit(None).cast("string").alias("type"), F.lit(True).alias("gone")))
    each = objects.select(F.explode(F.concat(there, gone)).alias("e")).select("e.*")
    found = each.select("field", F.when(F.col("gone"), "missing").otherwise(status).alias("status"), F.col("type").alias("found"))
    return _counted(found.where("status IS NOT NULL"), "field", "status", "found")


def merged_schema(records: DataFrame, payload: str = "value") -> str:
    """The one type that holds every record, as DDL text (``OBJECT<…>``), merged
    by a partial aggregate; ``VOID`` if no payload is JSON."""
    return records.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(payload).cast("string"))).alias("s")).first()["s"]
