"""Column functions on every edge value."""

from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from postlake.functions import (age_group, full_name, null_if_in, parse_follower_count,
                                parse_follower_count_scaled, percent_encode, strip_prefix,
                                to_ts, tolerant_int)
from postlake.functions.udfs import parse_follower_count_udf


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


FOLLOWER_CASES = [
    ("5k", 5000), ("1.5k", 1), ("3M", 3000000), ("100", 100), ("n/a", None), ("", None), ("M", 0),
    (None, None), ("k", 0), ("5K", None), ("99999999999", None), ("3000M", None),
    (" 12 ", 12), ("+5", 5), ("-3", -3), ("1e3", None), (".5", 0), ("1.", 1), (".", 0), ("0x1", None),
    ("1_000", None), ("2147483647", 2147483647), ("2147483648", None), ("12.999k", 12),
]


@pytest.mark.parametrize("parser", [parse_follower_count, parse_follower_count_udf])
def test_follower_count(spark, parser):
    df = one_col(spark, [v for v, _ in FOLLOWER_CASES]).select("x", parser("x").alias("y"))
    got = {r.x: r.y for r in df.collect()}
    for value, expected in FOLLOWER_CASES:
        assert got[value] == expected, (value, got[value], expected)


def test_follower_count_scaled(spark):
    cases = [("1.5k", 1500), ("5k", 5000), ("3M", 3000000), ("0.0009999k", 0), ("1.2345k", 1234),
             ("2.5M", 2500000), ("-1.5k", -1500), ("100", 100), ("n/a", None), ("", None), (None, None),
             ("k", None), ("5K", None), ("3000M", None), (".5k", 500), ("7.k", 7000)]
    df = one_col(spark, [v for v, _ in cases]).select("x", parse_follower_count_scaled("x").alias("y"))
    got = {r.x: r.y for r in df.collect()}
    for value, expected in cases:
        assert got[value] == expected, (value, got[value], expected)


def test_tolerant_int_never_raises_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    rows = one_col(spark, ["abc", "", "1.2000", "99999999999999999999", None]).select(
        tolerant_int("x").alias("y")).collect()
    assert [r.y for r in rows] == [None, None, 1, None, None]


def test_null_if_in(spark):
    df = one_col(spark, ["User Info Error", "", None, "ok", "User Info Error "])
    got = [r.y for r in df.select(null_if_in("x", "User Info Error", "").alias("y")).collect()]
    assert got == [None, None, None, "ok", "User Info Error "]


def test_strip_prefix_removes_every_occurrence(spark):
    df = one_col(spark, ["Local save in /data/a", "/x/Local save in y", "Local save in Local save in z", None])
    got = [r.y for r in df.select(strip_prefix("x").alias("y")).collect()]
    assert got == ["/data/a", "/x/y", "z", None]


def test_full_name_skips_nulls(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None), (None, None)], "f string, l string")
    assert [r.n for r in df.select(full_name("f", "l").alias("n")).collect()] == ["a b", "b", "a", ""]


def test_age_group_edges(spark):
    ages = [17, 18, 24, 25, 35, 36, 50, 51, None, 0, 120]
    want = ["50+", "18-24", "18-24", "25-35", "25-35", "36-50", "36-50", "50+", "50+", "50+", "50+"]
    df = one_col(spark, ages, "int").select(age_group("x").alias("g"))
    assert [r.g for r in df.collect()] == want


def test_age_group_sql_form_agrees(spark):
    from postlake.functions import age_group_sql
    df = one_col(spark, [17, 18, 24, 25, 35, 36, 50, 51, None], "int")
    a = [r.g for r in df.select(age_group("x").alias("g")).collect()]
    b = [r.g for r in df.select(F.expr(age_group_sql("x")).alias("g")).collect()]
    assert a == b


def test_to_ts(spark):
    import datetime as dt
    df = one_col(spark, ["2020-01-02 03:04:05", "2020-01-02T03:04:05", "2020-01-02", "bad", "", None])
    got = [r.t for r in df.select(to_ts("x").alias("t")).collect()]
    assert got == [dt.datetime(2020, 1, 2, 3, 4, 5), dt.datetime(2020, 1, 2, 3, 4, 5),
                   dt.datetime(2020, 1, 2), None, None, None]
    assert df.select(to_ts("x").alias("t")).schema["t"].dataType.typeName() == "timestamp_ntz"


def test_percent_encode_matches_python_quote(spark):
    texts = ["abc XYZ 019", "a b*~é漢/+%_-.!", "key+with/slash=and&amp", "tab\tnew\nline", "~~**  ++",
             "".join(chr(c) for c in range(32, 127)), "emoji 😀 and ß", ""]
    df = one_col(spark, texts).select("x", percent_encode("x").alias("y"))
    for r in df.collect():
        assert r.y == quote(r.x, safe=""), r.x


def test_tolerant_int_equals_the_non_ansi_cast(spark):
    """Property check on random strings: same result as Spark's cast with ANSI off."""
    import random
    rng = random.Random(20)
    alphabet = " +-.0123456789ekM\t"
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 8))) for _ in range(4000)]
    values += [".", "-.", "2147483647", "2147483648", "-2147483648", "-2147483649", "\t5\t", "1.5.", "٣"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = {r.x: r.y for r in df.select("x", F.col("x").cast("int").alias("y")).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    mine = {r.x: r.y for r in df.select("x", tolerant_int("x").alias("y")).collect()}
    assert {k: (legacy[k], mine[k]) for k in legacy if legacy[k] != mine[k]} == {}


def test_cluster_conf_sizes_partitions():
    from postlake.session import cluster_conf
    big = cluster_conf(100 * 2**40, executors=1000)
    assert 8000 <= int(big["spark.sql.shuffle.partitions"]) <= 100_000
    assert big["spark.sql.adaptive.enabled"] == "true"
    small = cluster_conf(10 * 2**20, executors=2, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def _scaled_model(text):
    """Exact Python model of the scaled follower count."""
    import re
    from decimal import Decimal
    if text is None:
        return None
    m = re.fullmatch(r"[ \t\n\r\f\v]*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]*))([kM]?)[ \t\n\r\f\v]*", text)
    if not m:
        return None
    number, suffix = m.groups()
    digits = number.lstrip("+-")
    if digits in ("", "."):
        value = Decimal(0)
    else:
        value = Decimal(number if not number.endswith(".") else number + "0")
        if digits.startswith("."):
            value = Decimal(number.replace(".", "0.", 1))
    value *= {"k": 1000, "M": 1000000, "": 1}[suffix]
    whole = int(value)  # truncates toward zero
    return whole if -2**31 <= whole < 2**31 else None


def test_follower_count_scaled_equals_exact_decimal_model(spark):
    import random
    rng = random.Random(33)
    pieces = ["", "+", "-", " "]
    values = []
    for _ in range(3000):
        whole = "".join(rng.choice("0123456789") for _ in range(rng.randint(0, 11)))
        frac = "".join(rng.choice("0123456789") for _ in range(rng.randint(0, 8)))
        dot = rng.choice(["", ".", "."])
        values.append(rng.choice(pieces) + whole + dot + frac + rng.choice(["", "k", "M", "K", "x"]) + rng.choice(["", " "]))
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = {r.x: r.y for r in df.select("x", parse_follower_count_scaled("x").alias("y")).collect()}
    bad = {v: (got[v], _scaled_model(v)) for v in values if got[v] != _scaled_model(v)}
    assert bad == {}


def test_native_follower_count_equals_udf_rule_with_non_ansi_cast(spark):
    """The default native path against the reference recipe: the Python text
    rule, then Spark's cast to int with ANSI off."""
    import random

    from postlake.functions.udfs import standardise_follower_count
    rng = random.Random(44)
    alphabet = " +-.0123456789kMK"
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    expanded = df.select("x", standardise_follower_count("x").alias("t")).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        reference = {r.x: r.y for r in spark.createDataFrame(expanded, "x string, t string")
                     .select("x", F.col("t").cast("int").alias("y")).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    native = {r.x: r.y for r in df.select("x", parse_follower_count("x").alias("y")).collect()}
    assert {v: (native[v], reference[v]) for v in values if native[v] != reference[v]} == {}


def test_timestamps_with_and_without_a_zone(spark):
    from postlake.functions.time import to_ts
    rows = [("2018-12-31T23:30:00-05:00", "2019-01-01 04:30:00"), ("2019-01-01T00:30:00+09:00", "2018-12-31 15:30:00"),
            ("2018-12-31T23:30:00Z", "2018-12-31 23:30:00"), ("2018-12-31 23:30:00", "2018-12-31 23:30:00"),
            ("2018-12-31", "2018-12-31 00:00:00"), ("soon", None), (None, None)]
    df = spark.createDataFrame(rows, "t string, want string").withColumn("ts", to_ts("t"))
    assert df.schema["ts"].dataType.simpleString() == "timestamp_ntz"
    assert [(None if r.ts is None else str(r.ts)) for r in df.collect()] == [w for _, w in rows]
    typed = spark.sql("select timestamp_ntz '2020-02-03 04:05:06' as a, timestamp '2020-02-03 04:05:06' as b")
    assert [str(x) for x in typed.select(to_ts("a"), to_ts("b")).first()] == ["2020-02-03 04:05:06"] * 2
