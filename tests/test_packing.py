"""Envelopes of many records: limits, order, and the way back."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.operators.decode import unpack_envelope
from postlake.operators.packing import cuts, pack_envelopes
from postlake.plans.lake import lake
from postlake.schemas import RAW, RAW_USERS


def brute_cuts(sizes, max_records, max_bytes, used, held):
    out = []
    for i, s in enumerate(sizes):
        if held and (held + 1 > max_records or used + s > max_bytes):
            out.append(i)
            used, held = 0, 0
        used, held = used + s, held + 1
    return out


def test_cuts_are_greedy():
    rng = random.Random(1)
    for _ in range(500):
        sizes = np.array([rng.randint(1, 30) for _ in range(rng.randint(0, 25))], np.int64)
        held = rng.randint(0, 3)
        used = rng.randint(1, 20) if held else 0
        args = rng.randint(max(held, 1), 6), rng.randint(max(used, 1), 60)
        got = cuts(sizes, *args, used, held)
        assert got == brute_cuts(sizes.tolist(), *args, used, held)


def users(spark, n, tasks):
    name = F.concat(F.lit("né\""), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")))
    return spark.range(0, n, 1, tasks).select(
        F.col("id").alias("ind"), name.alias("first_name"), F.when(F.col("id") % 5 > 0, F.lit("L")).alias("last_name"),
        F.lit(None).cast("int").alias("age"), F.lit("2020-01-01 00:00:00").alias("date_joined"))


@pytest.mark.parametrize("max_records, max_bytes", [(500, 1 << 20), (7, 1 << 20), (500, 700), (1, 5000), (3, 200)])
def test_limits_order_and_round_trip(spark, max_records, max_bytes):
    df = users(spark, 400, 3)
    sent = pack_envelopes(df, max_records, max_bytes)
    rows = sent.orderBy("task", "number").collect()
    for r in rows:
        assert r.n_records == len(json.loads(r.value)["records"]) <= max_records
        assert r.n_bytes == len(r.value.encode()) and r.n_bytes <= max_bytes and not r.oversize
    order = [rec["value"]["ind"] for r in rows for rec in json.loads(r.value)["records"]]
    assert order == list(range(400))
    for a, b in zip(rows, rows[1:]):  # no envelope could have taken the next record
        if a.task == b.task:
            first = json.loads(b.value)["records"][0]
            assert a.n_records == max_records or a.n_bytes + 1 + len(json.dumps(first, ensure_ascii=False, separators=(",", ":")).encode()) > max_bytes
    back = unpack_envelope(sent, RAW_USERS, "records")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_oversize_empty_and_refused(spark):
    df = users(spark, 4, 1).withColumn("first_name", F.when(F.col("ind") == 2, F.repeat(F.lit("y"), 5000)).otherwise(F.lit("z")))
    rows = pack_envelopes(df, 500, 1000).orderBy("task", "number").collect()
    assert [(r.n_records, r.oversize) for r in rows] == [(2, False), (1, True), (1, False)]
    assert pack_envelopes(df.where("1 = 0")).count() == 0
    with pytest.raises(ValueError):
        pack_envelopes(df, 0)


def test_posts_by_the_default_limits(spark, sf_small):
    raw = lake(spark, sf_small).raw("posts")
    sent = pack_envelopes(raw)
    assert sent.agg(F.max("n_records"), F.max("n_bytes"), F.sum("n_records")).first()[2] == raw.count()
    assert unpack_envelope(sent, RAW["posts"], "records").exceptAll(raw).count() == 0
