"""Fields added, missing and retyped against the declared schema."""

import json
from collections import Counter

from postlake.operators.decode import to_records
from postlake.operators.drift import field_types, merged_schema, schema_drift
from postlake.plans.lake import lake
from postlake.schemas import RAW, RAW_GEO

OBJECTS = [
    {"ind": 1, "timestamp": "t", "latitude": 1.5, "longitude": 2, "country": "x"},
    {"ind": 2, "timestamp": "t", "latitude": 1e30, "longitude": "2", "country": None, "extra": 1},
    {"ind": 3.5, "timestamp": 12, "latitude": [1], "country": "y", "extra": "a", "more": {"deep": True}},
    {"ind": True},
    {},
]
OTHERS = ["[1]", "7", "not json", "", None, '{"ind":1,"ind":2}']


def records(spark):
    return spark.createDataFrame([(json.dumps(o),) for o in OBJECTS] + [(t,) for t in OTHERS], "value string")


def kind(v):
    return {bool: "BOOLEAN", int: "BIGINT", str: "STRING", list: "ARRAY", dict: "OBJECT", type(None): "VOID"}.get(type(v)) or (
        "DOUBLE" if abs(v) > 1e20 else "DECIMAL")


def test_types_are_counted(spark):
    want = Counter((f, kind(v)) for o in OBJECTS for f, v in o.items())
    assert {(r.field, r.type): r.n for r in field_types(records(spark)).collect()} == want


def test_drift(spark):
    got = {(r.field, r.status, r.found): r.n for r in schema_drift(records(spark), RAW_GEO).collect()}
    assert got == {
        ("extra", "added", "BIGINT"): 1, ("extra", "added", "STRING"): 1, ("more", "added", "OBJECT"): 1,
        ("longitude", "retyped", "STRING"): 1, ("ind", "retyped", "DECIMAL"): 1, ("ind", "retyped", "BOOLEAN"): 1,
        ("timestamp", "retyped", "BIGINT"): 1, ("latitude", "retyped", "ARRAY"): 1,
        ("ind", "missing", None): 1, ("timestamp", "missing", None): 2, ("latitude", "missing", None): 2,
        ("longitude", "missing", None): 3, ("country", "missing", None): 3}


def test_topics_that_fit_only_miss_nulls(spark, sf_small):
    lk = lake(spark, sf_small)
    for name, schema in RAW.items():
        rows = schema_drift(to_records(lk.raw(name)), schema).collect()
        assert {r.status for r in rows} <= {"missing"}
        nulls = {c: lk.raw(name).where(f"`{c}` is null").count() for c in schema.fieldNames()}
        assert {r.field: r.n for r in rows} == {c: n for c, n in nulls.items() if n}


def test_empty_topic_and_one_shuffle(spark):
    none = records(spark).where("1 = 0")
    assert schema_drift(none, RAW_GEO).count() == 0 and field_types(none).count() == 0 and merged_schema(none) == "VOID"
    plan = schema_drift(records(spark), RAW_GEO)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Python" not in plan


def test_merged_schema(spark):
    df = spark.createDataFrame([('{"a":1,"b":"x"}',), ('{"a":2.5}',), ("bad",)], "value string")
    assert merged_schema(df).replace(" ", "") == "OBJECT<a:DECIMAL(21,1),b:STRING>"
