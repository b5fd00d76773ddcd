"""Records that cannot be read are set aside with a reason; none is lost."""

import pytest
from pyspark.sql import functions as F

from postlake.operators.quarantine import (check_records, read_good, read_quarantine, start_routed, write_routed)
from postlake.schemas import RAW_GEO, RAW_USERS

CASES = [  # payload, reason, bad fields
    ('{"ind":1,"first_name":"A","age":30}', None, None),
    ('{"ind":2}', None, None),
    ('{"ind":3,"age":null,"other":[1]}', None, None),
    ("{'ind':4}", None, None),  # single quotes are read, as without the check
    ('{"ind":5,"age":"old"}', "bad_field", ["age"]),
    ('{"ind":"x","age":{},"first_name":"B"}', "bad_field", ["ind", "age"]),
    ('{"ind":6,"first_name":"C"', "not_json", None),
    ("plain text", "not_json", None),
    ("[]", "not_object", None),
    ('"text"', "not_object", None),
    ("7", "not_object", None),
    ("", "empty", None),
    (" \n", "empty", None),
    (None, "empty", None),
    ("{}", "no_key", None),
    ('{"first_name":"D"}', "no_key", None),
    ('{"ind":null}', "no_key", None),
]


def checked(spark, key="ind"):
    df = spark.createDataFrame([(p,) for p, *_ in CASES], "value string").select(F.col("value").cast("binary").alias("data"))
    return check_records(df, RAW_USERS, "data", key)


def test_reasons(spark):
    got = checked(spark).collect()
    for r, (payload, reason, bad) in zip(got, CASES):
        assert (r.reason, r.bad_fields) == (reason, bad), payload
        assert (r.row is None) == (reason is not None) and r.record == (None if reason is None else payload)
    assert [r.row.ind for r in got if r.row] == [1, 2, 3, 4]
    assert {r.reason for r in checked(spark, key=None).collect()} == {None, "empty", "not_json", "not_object", "bad_field"}


def test_good_and_quarantined_are_the_input(spark, tmp_path):
    path = str(tmp_path / "t")
    counts = write_routed(checked(spark), path)
    good, bad = read_good(spark, path, RAW_USERS), read_quarantine(spark, path, RAW_USERS)
    assert counts["records"] == len(CASES) == good.count() + bad.count()
    assert counts["good"] == good.count() == 4
    assert {r.reason: r["count"] for r in bad.groupBy("reason").count().collect()} == {
        k: counts[k] for k in ("empty", "not_json", "not_object", "bad_field", "no_key")}
    assert good.schema == RAW_USERS
    files = [f for f in good.inputFiles()]
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert files and "PartitionFilters: [isnotnull(route" in plan.replace("\n", " ")


def test_the_write_reads_the_input_once(spark, tmp_path):
    acc = spark.sparkContext.accumulator(0)

    def touch(rows):
        for b in rows:
            acc.add(b.num_rows)
            yield b
    df = spark.createDataFrame([(p,) for p, *_ in CASES], "value string").mapInArrow(touch, "value string")
    write_routed(check_records(df, RAW_USERS, "value", "ind"), str(tmp_path / "t"))
    assert acc.value == len(CASES)


def test_all_good_all_bad_and_none(spark, tmp_path):
    one = spark.createDataFrame([('{"ind":1}',)], "value string")
    for name, df, n in (("good", one, (1, 0)), ("bad", one.select(F.lit("x").alias("value")), (0, 1)), ("none", one.where("1 = 0"), (0, 0))):
        path = str(tmp_path / name)
        write_routed(check_records(df, RAW_GEO, "value", "ind"), path)
        assert (read_good(spark, path, RAW_GEO).count(), read_quarantine(spark, path, RAW_GEO).count()) == n


def test_stream_equals_batch_and_reports_counts(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([(p,) for p, *_ in CASES if p and "\n" not in p], "value string").coalesce(1).write.text(src)
    records = spark.readStream.format("text").load(src)
    q = start_routed(check_records(records, RAW_USERS, "value", "ind"), out, str(tmp_path / "c"))
    q.awaitTermination()
    assert q.exception() is None
    seen = q.lastProgress["observedMetrics"]["routed"]
    good, bad = read_good(spark, out, RAW_USERS).count(), read_quarantine(spark, out, RAW_USERS).count()
    assert (good, bad) == (4, sum(1 for p, r, _ in CASES if r and p and "\n" not in p))
    got = seen if isinstance(seen, dict) else seen.asDict()
    assert got["records"] == good + bad and got["good"] == good


@pytest.mark.parametrize("name", ["a.b", "with 'quote'", "__corrupt"])
def test_odd_field_names(spark, name):
    from pyspark.sql.types import LongType, StructType
    schema = StructType().add(name, LongType())
    import json
    df = spark.createDataFrame([(json.dumps({name: 1}),), (json.dumps({name: "x"}),)], "value string")
    got = check_records(df, schema, "value").collect()
    assert [r.reason for r in got] == [None, "bad_field"] and got[0].row[0] == 1
