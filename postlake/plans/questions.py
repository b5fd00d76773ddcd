"""The analytics questions, over the clean tables.

``g``, ``p``, ``u`` are clean geolocation, posts and users frames (any
source: lake tables, freshly cleaned batches, stream output).  Tables are
aligned by row offset and joined on ``ind``; offsets repeat, so every count
is a count of *join rows*, exactly as an inner join would give.  Counting and
median questions never join two raw sides: every side but posts is first
summarised per key (:mod:`postlake.operators.joins`), so a hot key costs its
post rows times its few distinct values on the other side, never the product
of its row counts.

Ties are broken explicitly so every answer is deterministic: categories by
name, users by ``ind`` then name, countries by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import age_group
from postlake.operators.joins import joined_counts
from postlake.operators.median import weighted_lower_median
from postlake.operators.quantiles import build_sketches, merged_quantile
from postlake.operators.skew_join import split_join
from postlake.operators.topk import top_n_per_group

KEY = "ind"


def _year_start(year: int) -> Column:
    return F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")


def in_years(ts: str, lo: int | None, hi: int | None) -> Column | None:
    """``year(ts) BETWEEN lo AND hi`` written as a timestamp range, which the
    Parquet scan can use to skip row groups (``year()`` itself is not pushed)."""
    conds = []
    if lo is not None:
        conds.append(F.col(ts) >= _year_start(lo))
    if hi is not None:
        conds.append(F.col(ts) < _year_start(hi + 1))
    if not conds:
        return None
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def of_years(df: DataFrame, ts: str, lo: int | None, hi: int | None) -> DataFrame:
    """Rows with ``year(ts)`` in lo..hi.  A table partitioned by year (column
    ``<ts>_year``, see the lake) is asked by that column too, so the scan
    opens the folders of those years only."""
    cond = in_years(ts, lo, hi)
    if cond is None:
        return df
    year = F.col(f"{ts}_year")
    if f"{ts}_year" in df.columns:
        for bound in ([] if lo is None else [year >= lo]) + ([] if hi is None else [year <= hi]):
            cond = cond & bound
    return df.where(cond)


# ---------------------------------------------------------------- joins

# ``cells`` (see postlake.operators.skew_join.plan_cells) deals the rows of heavy
# keys over several tasks; without it they are left to Spark's own skew handling.

def join_geo_posts(g: DataFrame, p: DataFrame, cells: dict | None = None) -> DataFrame:
    """Every geo ⋈ posts row: ind, country, timestamp, category, follower_count."""
    return split_join([g.select(KEY, "country", "timestamp"), p.select(KEY, "category", "follower_count")],
                      KEY, cells or {})


def join_users_posts(u: DataFrame, p: DataFrame, cells: dict | None = None) -> DataFrame:
    """Every users ⋈ posts row: ind, user_name, age, date_joined, category, follower_count."""
    return split_join([u.select(KEY, "user_name", "age", "date_joined"), p.select(KEY, "category", "follower_count")],
                      KEY, cells or {})


def join_three_way(g: DataFrame, p: DataFrame, u: DataFrame, cells: dict | None = None) -> DataFrame:
    """Every geo ⋈ posts ⋈ users row: ind, country, user_name, category, follower_count.
    Both joins use the same key (and cell).  Without ``cells`` a hot key is split in
    both where ``spark.sql.adaptive.forceOptimizeSkewedJoin`` is on (the session
    helpers set it), at the price of a shuffle of the middle result in that case."""
    sides = [g.select(KEY, "country"), p.select(KEY, "category", "follower_count"), u.select(KEY, "user_name")]
    return split_join(sides, KEY, cells or {}).select(KEY, "country", "user_name", "category", "follower_count")


# ---------------------------------------------------------------- categories

def category_counts_by_country(g: DataFrame, p: DataFrame, sort: bool = True) -> DataFrame:
    """Posts per (country, category), most first: country, category, n."""
    out = joined_counts([(g, ["country"]), (p, ["category"])], KEY, "n")
    return out.orderBy(F.desc("n"), "country", "category") if sort else out


def top_category_by_country(g: DataFrame, p: DataFrame) -> DataFrame:
    """Most popular category in each country: country, category, n."""
    counts = category_counts_by_country(g, p, sort=False)
    return top_n_per_group(counts, ["country"], [F.desc("n"), F.asc("category")])


def posts_per_category_year(g: DataFrame, p: DataFrame, lo: int = 2018, hi: int = 2022) -> DataFrame:
    """Posts per (post year, category) for post years lo..hi: post_year, category, n."""
    years = of_years(g, "timestamp", lo, hi).select(
        KEY, F.year("timestamp").alias("post_year"))
    return joined_counts([(years, ["post_year"]), (p, ["category"])], KEY, "n")


def top_category_by_year(g: DataFrame, p: DataFrame, lo: int = 2018, hi: int = 2022) -> DataFrame:
    """Most popular category in each post year: post_year, category, n."""
    counts = posts_per_category_year(g, p, lo, hi)
    return top_n_per_group(counts, ["post_year"], [F.desc("n"), F.asc("category")])


# ---------------------------------------------------------------- most-followed user

def top_user_by_country(g: DataFrame, p: DataFrame, u: DataFrame) -> DataFrame:
    """User with the most followers in each country: country, user_name, follower_count.

    Ranks the geo ⋈ posts ⋈ users rows by (follower_count desc, ind, user_name)
    without building that join.  Within one ``ind`` the best row pairs the
    largest follower count of its posts with the smallest name of its users,
    and repeated rows cannot change a top-1 answer, so every side shrinks to
    per-key rows first: geo to distinct (ind, country) — map-side partial
    aggregation collapses a hot key to its few countries before any shuffle —
    and posts and users, in one aggregation over their union, to
    ``max(follower_count)`` per ``ind`` for keys present in both (keeping the
    inner-join meaning).  The winning ``ind`` of each
    country comes from a partial ``WindowGroupLimit``, and only the winners'
    users are read for the name, through a join with the small winners table
    (AQE broadcasts it when its runtime size allows, and splits a hot key's
    users otherwise).  No join sees more than a few rows per key on its
    summarised side, and no string aggregate runs over the whole users table.
    """
    places = g.where(F.col(KEY).isNotNull()).select(KEY, "country").distinct()
    # posts and users in one aggregation on ind: the best follower count and
    # whether the key has a post and a user row (one shuffle, map-side combine)
    tagged = (p.select(KEY, "follower_count", F.lit(True).alias("_post"), F.lit(False).alias("_user"))
               .unionByName(u.select(KEY, F.lit(None).cast("int").alias("follower_count"),
                                     F.lit(False).alias("_post"), F.lit(True).alias("_user"))))
    best = (tagged.where(F.col(KEY).isNotNull()).groupBy(KEY)
                  .agg(F.max("follower_count").alias("follower_count"),
                       F.bool_or("_post").alias("_post"), F.bool_or("_user").alias("_user"))
                  .where(F.col("_post") & F.col("_user"))
                  .select(KEY, "follower_count"))  # one row per key present in both
    cands = places.join(best, KEY, "inner")
    winners = top_n_per_group(cands, ["country"], [F.desc_nulls_last("follower_count"), F.asc(KEY)])
    named = winners.join(u.select(KEY, "user_name"), KEY, "inner")
    top = top_n_per_group(named, ["country"], [F.asc("user_name")])
    return top.select("country", "user_name", "follower_count")


def top_country_by_followers(g: DataFrame, p: DataFrame, u: DataFrame) -> DataFrame:
    """The country whose top user has the most followers (one row)."""
    return (top_user_by_country(g, p, u)
            .orderBy(F.desc_nulls_last("follower_count"), F.asc("country"))
            .limit(1))


# ---------------------------------------------------------------- age groups

def age_bands(u: DataFrame) -> DataFrame:
    """ind, age, age_group for every user row."""
    return u.select(KEY, "age", age_group("age").alias("age_group"))


def _banded_counts(u: DataFrame, p: DataFrame, fact_cols: list[str], out: str) -> DataFrame:
    """count(*) of users ⋈ posts per (age band, fact columns)."""
    bands = u.select(KEY, age_group("age").alias("age_group"))
    return joined_counts([(bands, ["age_group"]), (p, fact_cols)], KEY, out)


def category_counts_by_age_group(u: DataFrame, p: DataFrame) -> DataFrame:
    """Posts per (age group, category): age_group, category, category_count."""
    return _banded_counts(u, p, ["category"], "category_count")


def top_category_by_age_group(u: DataFrame, p: DataFrame) -> DataFrame:
    """Most popular category per age group: age_group, category, category_count."""
    counts = category_counts_by_age_group(u, p)
    return top_n_per_group(counts, ["age_group"], [F.desc("category_count"), F.asc("category")])


def _median_followers(users: DataFrame, group_cols: list[str], p: DataFrame) -> DataFrame:
    """Lower median of posts.follower_count over users ⋈ posts rows per group."""
    weights = joined_counts([(users, group_cols), (p, ["follower_count"])], KEY, "_weight")
    return weighted_lower_median(weights, group_cols, "follower_count", "_weight", "median_follower_count")


def median_followers_by_age_group(u: DataFrame, p: DataFrame) -> DataFrame:
    """age_group, median_follower_count."""
    weights = _banded_counts(u, p, ["follower_count"], "_weight")
    return weighted_lower_median(weights, ["age_group"], "follower_count", "_weight", "median_follower_count")


# ---------------------------------------------------------------- join years (A5-A7, A5r-A7r)

def _join_years(u: DataFrame, lo: int | None, hi: int | None, *extra: Column) -> DataFrame:
    return of_years(u, "date_joined", lo, hi).select(
        KEY, *extra, F.year("date_joined").alias("year_joined"))


def users_joined_by_year(u: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """User rows per join year: year_joined, number_users_joined."""
    years = _join_years(u, lo, hi)
    return years.groupBy("year_joined").agg(F.count(F.lit(1)).alias("number_users_joined"))


def median_followers_by_join_year(u: DataFrame, p: DataFrame, lo: int | None = None,
                                  hi: int | None = None) -> DataFrame:
    """year_joined, median_follower_count."""
    return _median_followers(_join_years(u, lo, hi), ["year_joined"], p)


def median_followers_by_age_group_year(u: DataFrame, p: DataFrame, lo: int | None = None,
                                       hi: int | None = None) -> DataFrame:
    """age_group, year_joined, median_follower_count, sorted by the two keys."""
    years = _join_years(u, lo, hi, age_group("age").alias("age_group"))
    out = _median_followers(years, ["age_group", "year_joined"], p)
    return out.orderBy("age_group", "year_joined")


# ---------------------------------------------------------------- stored sketches

def follower_sketches(u: DataFrame, p: DataFrame) -> DataFrame:
    """Quantile sketches of posts.follower_count over users ⋈ posts rows, per age
    group and join year: store them, and answer the median questions from them."""
    return build_sketches(follower_weights(u, p), ["age_group", "year_joined"], "follower_count", "_weight")


def follower_weights(u: DataFrame, p: DataFrame) -> DataFrame:
    """Join rows per (age_group, year_joined, follower_count), as ``_weight``."""
    years = _join_years(u, None, None, age_group("age").alias("age_group"))
    return joined_counts([(years, ["age_group", "year_joined"]), (p, ["follower_count"])], KEY, "_weight")


def sketched_median_followers(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """``(group…, n_rows, median_follower_count)`` from stored sketches alone;
    ``groups`` is any of age_group, year_joined, or both."""
    return merged_quantile(sketches, groups, "median_follower_count")


def median_rank_error(weights: DataFrame, medians: DataFrame, groups: list[str]) -> DataFrame:
    """``medians`` with ``rank_error``: how far, as a share of the group's rows,
    the ranks its value takes in ``weights`` are from a half (0 if they include
    it, NULL without a value)."""
    w = weights.where("follower_count IS NOT NULL").select(*[F.col(c).alias(f"w_{c}") for c in groups], "follower_count", "_weight")
    same = [F.col(c).eqNullSafe(F.col(f"w_{c}")) for c in groups]
    below = F.when(F.col("follower_count") < F.col("median_follower_count"), F.col("_weight")).otherwise(0)
    upto = F.when(F.col("follower_count") <= F.col("median_follower_count"), F.col("_weight")).otherwise(0)
    ranks = medians.join(w, same, "left").groupBy(*groups, "n_rows", "median_follower_count").agg(
        F.sum(below).alias("below"), F.sum(upto).alias("upto"))
    error = F.greatest(F.col("below") / F.col("n_rows") - 0.5, 0.5 - F.col("upto") / F.col("n_rows"), F.lit(0.0))
    return ranks.select(*groups, "n_rows", "median_follower_count", F.when(F.col("n_rows") > 0, error).alias("rank_error"))
