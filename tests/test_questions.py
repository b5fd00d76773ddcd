"""Questions on small clean frames against the plain SQL of the question
(full join, count(*), row_number, percentile), and ordering guarantees."""

import datetime as dt
import random

import pytest

from postlake.functions import age_group, age_group_sql
from postlake.plans import questions as q
from postlake.schemas import CLEAN_GEO, CLEAN_POSTS, CLEAN_USERS
from postlake.sinks.files import register_views


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(42)
    countries, cats = ["A", "B", "C"], ["art", "food", "travel", "diy"]
    geo, posts, users = [], [], []
    keys = [rng.randint(0, 60) for _ in range(220)] + [7] * 40  # repeated keys and a hot key
    for k in keys:
        geo.append((k, rng.choice(countries), [0.0, 0.0],
                    dt.datetime(rng.randint(2015, 2023), rng.randint(1, 12), 1)))
        posts.append((k, f"u{k}", None, None, rng.choice([None, rng.randint(0, 5000)]), None, None, None,
                      None, None, rng.choice(cats)))
        users.append((k, rng.choice(["ann", "bob", "cy"]), rng.choice([None, 15, 18, 24, 30, 40, 60]),
                      dt.datetime(rng.randint(2012, 2021), 1, 1)))
    g = spark.createDataFrame(geo, CLEAN_GEO)
    p = spark.createDataFrame(posts, CLEAN_POSTS)
    u = spark.createDataFrame(users, CLEAN_USERS)
    register_views(p, g, u)
    return g, p, u


def same(df, sql, spark):
    a = sorted((tuple(r) for r in df.collect()), key=repr)
    b = sorted((tuple(r) for r in spark.sql(sql).select(*df.columns).collect()), key=repr)
    assert a == b


JOIN = "countries g JOIN posts p ON g.ind = p.ind"
BANDS = f"(SELECT ind, {age_group_sql('age')} AS age_group, date_joined FROM users)"


def test_counts(tables, spark):
    g, p, u = tables
    same(q.category_counts_by_country(g, p),
         f"SELECT country, category, count(*) AS n FROM {JOIN} GROUP BY 1, 2", spark)
    same(q.posts_per_category_year(g, p),
         f"SELECT year(timestamp) AS post_year, category, count(*) AS n FROM {JOIN} "
         "WHERE year(timestamp) BETWEEN 2018 AND 2022 GROUP BY 1, 2", spark)
    same(q.category_counts_by_age_group(u, p),
         f"SELECT age_group, category, count(*) AS category_count FROM {BANDS} b JOIN posts p ON b.ind = p.ind "
         "GROUP BY 1, 2", spark)
    same(q.users_joined_by_year(u), "SELECT year(date_joined) AS year_joined, count(*) AS number_users_joined "
         "FROM users GROUP BY 1", spark)


def test_top_rows(tables, spark):
    g, p, u = tables
    same(q.top_user_by_country(g, p, u),
         "SELECT country, user_name, follower_count FROM (SELECT country, user_name, follower_count, "
         "row_number() OVER (PARTITION BY country ORDER BY follower_count DESC NULLS LAST, g.ind, user_name) rn "
         f"FROM {JOIN} JOIN users u ON g.ind = u.ind) WHERE rn = 1", spark)
    same(q.top_category_by_country(g, p),
         "SELECT country, category, n FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY n DESC, "
         f"category) rn FROM (SELECT country, category, count(*) n FROM {JOIN} GROUP BY 1, 2)) WHERE rn = 1", spark)
    top = q.top_country_by_followers(g, p, u).collect()
    best = max(r.follower_count for r in q.top_user_by_country(g, p, u).collect() if r.follower_count is not None)
    assert len(top) == 1 and top[0].follower_count == best


def test_medians(tables, spark):
    g, p, u = tables
    same(q.median_followers_by_age_group(u, p),
         f"SELECT age_group, percentile_disc(0.5) WITHIN GROUP (ORDER BY follower_count) AS median_follower_count "
         f"FROM {BANDS} b JOIN posts p ON b.ind = p.ind GROUP BY 1", spark)
    same(q.median_followers_by_age_group_year(u, p, 2015, 2020),
         "SELECT age_group, year(date_joined) AS year_joined, percentile_disc(0.5) WITHIN GROUP "
         f"(ORDER BY follower_count) AS median_follower_count FROM {BANDS} b JOIN posts p ON b.ind = p.ind "
         "WHERE year(date_joined) BETWEEN 2015 AND 2020 GROUP BY 1, 2", spark)


def test_orders(tables):
    g, p, u = tables
    counts = [r.n for r in q.category_counts_by_country(g, p).collect()]
    assert counts == sorted(counts, reverse=True)
    keys = [(r.age_group, r.year_joined) for r in q.median_followers_by_age_group_year(u, p).collect()]
    assert keys == sorted(keys, key=lambda k: (k[0], -1 if k[1] is None else k[1]))


def test_joins_keep_every_pair(tables, spark):
    g, p, u = tables
    assert q.join_geo_posts(g, p).count() == spark.sql(f"SELECT * FROM {JOIN}").count()
    assert q.join_three_way(g, p, u).count() == spark.sql(f"SELECT 1 FROM {JOIN} JOIN users u ON g.ind = u.ind").count()
    assert q.join_users_posts(u, p).columns == ["ind", "user_name", "age", "date_joined", "category", "follower_count"]


def test_year_filter_reaches_the_scan(spark, tmp_path, tables):
    g, p, _ = tables
    path = str(tmp_path / "geo")
    g.write.parquet(path)
    plan = q.posts_per_category_year(spark.read.parquet(path), p)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan


def test_plan_shapes(tables):
    g, p, u = tables
    plan = q.top_user_by_country(g, p, u)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    for df in (q.category_counts_by_country(g, p), q.median_followers_by_age_group(u, p)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_sql_forms_agree_with_dataframe_forms(tables, spark):
    from postlake.plans.sql import run_sql_question
    g, p, u = tables
    register_views(p, g, u)
    pairs = {
        "category_counts_by_country": q.category_counts_by_country(g, p),
        "top_category_by_country": q.top_category_by_country(g, p),
        "posts_per_category_year": q.posts_per_category_year(g, p),
        "top_category_by_year": q.top_category_by_year(g, p),
        "top_user_by_country": q.top_user_by_country(g, p, u),
        "top_country_by_followers": q.top_country_by_followers(g, p, u),
        "top_category_by_age_group": q.top_category_by_age_group(u, p),
    }
    for name, df in pairs.items():
        a = sorted((tuple(r) for r in df.collect()), key=repr)
        b = sorted((tuple(r) for r in run_sql_question(spark, name).select(*df.columns).collect()), key=repr)
        assert a == b, name


def test_sql_parameters_are_bound(tables, spark, sf_small):
    from postlake.plans.lake import lake
    from postlake.plans.sql import SQL_QUESTIONS, register_functions, run_sql_question
    g, p, _ = tables
    for lo, hi in ((2018, 2022), (2019, 2019), (2030, 2031)):
        got = run_sql_question(spark, "posts_per_category_year", lo=lo, hi=hi)
        assert sorted(map(tuple, got.collect())) == sorted(
            map(tuple, q.posts_per_category_year(g, p, lo, hi).select(*got.columns).collect()))
    lk = lake(spark, sf_small)
    register_views(lk.posts, lk.geo, lk.users)
    plan = run_sql_question(spark, "posts_per_category_year", lo=2019, hi=2019)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp,2019-01-01T00:00)" in plan.replace("\n", "")  # folded and pushed down
    with pytest.raises(TypeError):
        run_sql_question(spark, "posts_per_category_year", year=1)
    assert ":lo" in SQL_QUESTIONS["top_category_by_year"]()
    register_functions(spark)
    ages = spark.sql("SELECT id AS age, age_group(CAST(id AS INT)) AS s FROM range(-5, 130)").select("s", age_group("age").alias("d"))
    assert ages.where("s <> d").count() == 0
    assert spark.sql("SELECT age_group(NULL) AS s").first().s == "50+"
