"""Joins of tables where one key holds a third of all rows."""

import statistics

import pytest
from pyspark.sql import functions as F

from postlake.operators.skew_join import key_summary, merge_summaries, plan_cells, split_join
from postlake.plans import questions as q


@pytest.fixture
def plain_joins(spark):
    """No broadcast and no skew handling: what the join does by itself."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def table(spark, n, **columns):
    """``n`` rows, every third with key 0, some with none."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 41 == 1, F.lit(None)).otherwise(F.col("id"))
    return spark.range(0, n, 1, 5).select(key.cast("long").alias("ind"), *[F.expr(e).alias(c) for c, e in columns.items()])


def summary(df, tracked=64):
    return merge_summaries(key_summary(df, "ind", tracked=tracked), tracked)


def bag(df):
    return sorted(df.select(*sorted(df.columns)).collect(), key=repr)


def per_task(df):
    rows = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    return max(rows), statistics.median(rows)


def test_hot_key_is_spread(plain_joins):
    spark = plain_joins
    g = table(spark, 1800, country="concat('c', id % 7)", timestamp="timestamp_ntz '2020-01-01 00:00:00'")
    p = table(spark, 2100, category="concat('k', id % 5)", follower_count="cast(id as int)")
    cells = plan_cells([summary(g), summary(p)], 16)
    assert set(cells) == {0}
    plain, split = q.join_geo_posts(g, p), q.join_geo_posts(g, p, cells)
    top, mid = per_task(split)
    assert top <= 3 * mid
    assert per_task(plain)[0] > 10 * mid
    cols = ["ind", "country", "category", "follower_count"]
    count = F.count(F.lit(1)).alias("n")
    assert bag(split.groupBy(*cols).agg(count)) == bag(plain.groupBy(*cols).agg(count))
    assert "skew=true" not in split._jdf.queryExecution().executedPlan().toString()


def test_three_way_hot_key_is_spread_with_one_shuffle_a_side(plain_joins):
    spark = plain_joins
    g = table(spark, 180, country="concat('c', id % 7)")
    p = table(spark, 240, category="concat('k', id % 5)", follower_count="cast(id as int)")
    u = table(spark, 150, user_name="concat('u', id)")
    cells = plan_cells([summary(g), summary(p), summary(u)], 16)
    split, plain = q.join_three_way(g, p, u, cells), q.join_three_way(g, p, u)
    plan = split._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 3
    top, mid = per_task(split)
    assert top <= 3 * mid
    cols = ["ind", "country", "category", "user_name"]
    stats = [F.count(F.lit(1)).alias("n"), F.sum("follower_count").alias("s")]
    assert bag(split.groupBy(*cols).agg(*stats)) == bag(plain.groupBy(*cols).agg(*stats))


@pytest.mark.parametrize("cells", [{}, {0: (1, 4)}, {0: (3, 2), 5: (2, 1), 12345: (4, 4)}, {0: (2000, 1)}])
def test_any_plan_gives_the_join(plain_joins, cells):
    spark = plain_joins
    a, b = table(spark, 200, x="id"), table(spark, 150, y="-id")
    assert bag(split_join([a, b], "ind", cells)) == bag(a.join(b, "ind"))


def test_one_sided_skew_and_string_keys(plain_joins):
    spark = plain_joins
    a = table(spark, 3000, x="id").withColumn("ind", F.concat(F.lit("k"), "ind"))
    b = spark.range(0, 500).select(F.concat(F.lit("k"), "id").alias("ind"), (F.col("id") * 2).alias("y"))
    cells = plan_cells([summary(a), summary(b)], 16)
    assert cells["k0"][0] > 1 and cells["k0"][1] == 1
    assert bag(split_join([a, b], "ind", cells)) == bag(a.join(b, "ind"))


def test_summaries_merge_and_find_the_hot_key(spark):
    df = table(spark, 3000, part="id % 4")
    whole, merged = summary(df), merge_summaries(key_summary(df, "ind", by=["part"], tracked=64), 64)
    assert whole[1] == merged[1] == df.where("ind IS NOT NULL").count()
    assert whole[0][0] >= 1000 and merged[0][0] >= 1000
    empty = df.where("ind < 0")
    assert merge_summaries(key_summary(empty, "ind")) == ({}, 0)
    assert plan_cells([({}, 0), ({}, 0)], 8) == {}


def test_shared_names_are_refused(spark):
    a = table(spark, 5, x="id")
    with pytest.raises(ValueError):
        split_join([a, a], "ind", {})
