"""Stored quantile sketches against exact medians."""

import random

import pytest
from pyspark.sql import functions as F

from postlake.operators.quantiles import build_sketches, merged_quantile
from postlake.plans import questions as q
from postlake.plans.lake import lake


@pytest.fixture(scope="module")
def weighted(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.randrange(6), int(rng.lognormvariate(8, 2)), rng.choice([1, 1, 2, 3, 1000, 123_456_789]))
            for _ in range(6000)]
    rows += [("none", 1, None, 7), ("none", 2, 5, 0), ("one", 1, -3, 4), (None, 0, 10, 1), (None, 0, 20, 3)]
    return spark.createDataFrame(rows, "g string, y int, v int, w long").repartition(7), rows


def rank_error(rows, value, share):
    total = sum(w for v, w in rows)
    below, upto = sum(w for v, w in rows if v < value), sum(w for v, w in rows if v <= value)
    return max(0, below / total - share, share - upto / total)


@pytest.mark.parametrize("share", [0.5, 0.1, 0.99])
@pytest.mark.parametrize("groups", [["g"], ["y"], ["g", "y"], []])
def test_rank_error_of_merged_sketches(spark, weighted, tmp_path, groups, share):
    df, rows = weighted
    build_sketches(df, ["g", "y"], "v", "w").write.parquet(str(tmp_path / "s"))  # stored, then merged
    got = merged_quantile(spark.read.parquet(str(tmp_path / "s")), groups, "m", share).collect()
    place = [("g", "y").index(c) for c in groups]
    assert {tuple(r[c] for c in groups) for r in got} == {tuple(row[i] for i in place) for row in rows}
    for r in got:
        mine = [(v, w) for *k, v, w in rows if [k[i] for i in place] == [r[c] for c in groups] and v is not None and w > 0]
        assert r["n_rows"] == sum(w for _, w in mine)
        if mine:
            assert rank_error(mine, r["m"], share) <= 0.01
        else:
            assert r["m"] is None


def test_small_groups_are_exact(spark):
    df = spark.createDataFrame([(v, w) for v, w in [(1, 1), (5, 1), (9, 1), (9, 1), (12, 1)]], "v int, w int")
    assert merged_quantile(build_sketches(df, [], "v", "w"), [], "m").first().m == 9


def test_questions_from_the_lakes_sketches(spark, sf_small):
    lk = lake(spark, sf_small)
    weights = q.follower_weights(lk.users, lk.posts)
    for groups, exact in ((["age_group"], q.median_followers_by_age_group(lk.users, lk.posts)),
                          (["year_joined"], q.median_followers_by_join_year(lk.users, lk.posts)),
                          (["age_group", "year_joined"], q.median_followers_by_age_group_year(lk.users, lk.posts))):
        got = q.sketched_median_followers(lk.follower_sketches(), groups)
        assert {tuple(r) for r in got.select(*groups).collect()} == {tuple(r) for r in exact.select(*groups).collect()}
        checked = q.median_rank_error(weights, got, groups).where("n_rows > 0").collect()
        assert checked and all(r.rank_error <= 0.01 for r in checked)


def test_wrong_answers_have_an_error(spark, sf_small):
    lk = lake(spark, sf_small)
    weights = q.follower_weights(lk.users, lk.posts)
    off = q.sketched_median_followers(lk.follower_sketches(), ["age_group"]).withColumn("median_follower_count", F.lit(10**9).cast("long"))
    assert all(r.rank_error > 0.4 for r in q.median_rank_error(weights, off, ["age_group"]).collect())
