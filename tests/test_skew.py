"""A third of all rows share one key: the questions stay exact and never
build the quadratic join (checked against the plain join SQL)."""

import re

import pytest
from pyspark.sql import functions as F

from postlake.functions import age_group_sql
from postlake.plans import questions as q
from postlake.plans.lake import lake


def skew(df, every):
    return df.withColumn("ind", F.when(F.col("ind") % every == 0, F.lit(0)).otherwise(F.col("ind")))


@pytest.fixture(scope="module")
def skewed(spark, sf_small):
    lk = lake(spark, sf_small)
    return skew(lk.geo, 3), skew(lk.posts, 3), skew(lk.users, 3)


def same(df, sql, spark):
    a = sorted((tuple(r) for r in df.collect()), key=repr)
    b = sorted((tuple(r) for r in spark.sql(sql).select(*df.columns).collect()), key=repr)
    assert a == b


def test_hot_key_holds_a_third(skewed):
    g, _, _ = skewed
    total, hot = g.count(), g.where("ind = 0").count()
    assert hot * 3 >= total - 3


def test_counts_and_medians_under_skew(spark, skewed):
    g, p, u = skewed
    g.createOrReplaceTempView("sk_geo")
    p.createOrReplaceTempView("sk_posts")
    u.createOrReplaceTempView("sk_users")
    same(q.category_counts_by_country(g, p),
         "SELECT country, category, count(*) AS n FROM sk_geo g JOIN sk_posts p ON g.ind = p.ind GROUP BY 1, 2",
         spark)
    bands = f"(SELECT ind, {age_group_sql('age')} AS age_group FROM sk_users)"
    same(q.median_followers_by_age_group(u, p),
         "SELECT age_group, percentile_disc(0.5) WITHIN GROUP (ORDER BY follower_count) AS median_follower_count "
         f"FROM {bands} b JOIN sk_posts p ON b.ind = p.ind GROUP BY 1", spark)
    same(q.top_category_by_age_group(u, p),
         "SELECT age_group, category, category_count FROM (SELECT *, row_number() OVER (PARTITION BY age_group "
         "ORDER BY category_count DESC, category) rn FROM (SELECT age_group, category, count(*) category_count "
         f"FROM {bands} b JOIN sk_posts p ON b.ind = p.ind GROUP BY 1, 2)) WHERE rn = 1", spark)


def test_top_user_under_skew(spark, sf_small):
    lk = lake(spark, sf_small)
    g, p, u = skew(lk.geo, 10), skew(lk.posts, 10), skew(lk.users, 10)
    for name, df in (("s10_geo", g), ("s10_posts", p), ("s10_users", u)):
        df.createOrReplaceTempView(name)
    same(q.top_user_by_country(g, p, u),
         "SELECT country, user_name, follower_count FROM (SELECT country, user_name, follower_count, "
         "row_number() OVER (PARTITION BY country ORDER BY follower_count DESC NULLS LAST, g.ind, user_name) rn "
         "FROM s10_geo g JOIN s10_posts p ON g.ind = p.ind JOIN s10_users u ON g.ind = u.ind) WHERE rn = 1", spark)


def test_count_join_never_materialises_pairs(skewed):
    g, p, _ = skewed
    plan = q.category_counts_by_country(g, p)._jdf.queryExecution().optimizedPlan().toString()
    # the geo side is summarised per (ind, country) before the join; posts join row by row,
    # so a key costs its post rows times its distinct countries, never rows x rows
    assert len(re.findall(r"Aggregate \[ind#\d+L, country#\d+\]", plan)) == 1


def test_aqe_splits_the_hot_key_in_the_count_join(spark):
    """Without broadcasts, the posts rows of the hot key are split across tasks
    (eight input pieces, as tables of many files have: a partition is split
    between map outputs)."""
    lk = lake(spark, "/root/testdata/sf0.01")
    g, p = skew(lk.geo.repartition(8), 3), skew(lk.posts.repartition(8), 3)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        u = skew(lk.users.repartition(8), 3)
        for df in (q.category_counts_by_country(g, p), q.category_counts_by_age_group(u, p),
                   q.posts_per_category_year(g, p)):
            df.collect()
            assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_both_joins_of_the_three_way_join_split_the_hot_key(spark):
    def table(name):
        # half of the rows share one key
        return spark.range(0, 600, 1, 8).selectExpr("CASE WHEN id % 2 = 0 THEN 0L ELSE id END AS ind",
                                                    f"sha2(cast(id AS string), 512) AS {name}")
    g, u = table("country"), table("user_name")
    p = table("category").withColumn("follower_count", F.lit(1))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        counted = q.join_three_way(g, p, u).agg(F.count("user_name").alias("n"), F.max("country"), F.max("category"),
                                                     F.max("user_name"))
        assert counted.first().n == 300 ** 3 + 300
        counted.collect()
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert plan.split("Initial Plan")[0].count("SortMergeJoin(skew=true)") == 2
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
