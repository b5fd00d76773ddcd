"""Raw posts, geolocation and user records derived from the test data.

The records are a data specification over ``orders ⋈ customer ⋈ nation``:
every order becomes one post, one geolocation and one user record that share
the order key as ``index`` / ``ind``.  Orders whose key is a multiple of 50
appear twice, so keys repeat as they do upstream (rows are drawn with
replacement there).  Other modulo rules plant the placeholder values the
cleaning must handle.  Dates move forward 17 to 21 years so the year filters
of the questions select some rows and leave some out.  No row is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.schemas import RAW_GEO, RAW_POSTS, RAW_USERS, columns

# Fixed values of the specification (planted placeholder text).
NO_TITLE = "No Title Data Available"
NO_DESCRIPTION = "No description available Story format"
USER_INFO_ERROR = "User Info Error"
NO_TAGS = "N,o, ,T,a,g,s, ,A,v,a,i,l,a,b,l,e"
MULTI_VIDEO = "multi-video(story page format)"
IMAGE_ERROR = "Image src error."


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(k, ck, cat, d, c_name, n_name)`` with every 50th key doubled."""
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("ck"),
        F.col("o_orderpriority").alias("cat"), F.col("o_orderdate").alias("d"))
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = (orders.join(customer, orders.ck == customer.c_custkey)
                  .join(nation, customer.c_nationkey == nation.n_nationkey)
                  .select("k", "ck", "cat", "d", "c_name", "n_name"))
    copies = F.when(F.col("k") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return base.withColumn("_copy", F.explode(copies)).drop("_copy")


def _s(c: Column) -> Column:
    return c.cast("string")


def _shift_years(d: Column, years: int) -> Column:
    return d + F.make_ym_interval(F.lit(years), F.lit(0))


def raw_posts(src: DataFrame) -> DataFrame:
    k = F.col("k")
    follower = (F.when(k % 10 == 0, F.lit(USER_INFO_ERROR))
                 .when(k % 10 == 1, F.lit(""))
                 .when(k % 10 == 2, F.concat(_s(k % 997), F.lit("k")))
                 .when(k % 10 == 3, F.concat(_s(k % 9 + 1), F.lit("M")))
                 .when(k % 10 == 4, F.concat(_s(k % 9), F.lit(".5k")))
                 .when(k % 10 == 5, F.lit("n/a"))
                 .when(k % 10 == 6, F.lit(None).cast("string"))
                 .otherwise(_s(k * 37 % 100000)))
    out = src.select(
        k.alias("index"),
        F.concat(F.lit("post-"), _s(k)).alias("unique_id"),
        F.when(k % 11 == 0, F.lit(NO_TITLE)).when(k % 13 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("title "), _s(k))).alias("title"),
        F.when(k % 7 == 0, F.lit(NO_DESCRIPTION)).when(k % 12 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("about "), _s(k))).alias("description"),
        F.when(k % 17 == 0, F.lit(USER_INFO_ERROR)).otherwise(F.col("c_name")).alias("poster_name"),
        follower.alias("follower_count"),
        F.when(k % 19 == 0, F.lit(NO_TAGS)).otherwise(F.concat(F.col("cat"), F.lit(",x"))).alias("tag_list"),
        F.when(k % 23 == 0, F.lit(MULTI_VIDEO)).when(k % 2 == 0, F.lit("image"))
         .otherwise(F.lit("video")).alias("is_image_or_video"),
        F.when(k % 29 == 0, F.lit(IMAGE_ERROR))
         .otherwise(F.concat(F.lit("https://img.example.com/"), _s(k))).alias("image_src"),
        (k % 2).cast("int").alias("downloaded"),
        F.concat(F.lit("Local save in /data/"), F.col("cat")).alias("save_location"),
        F.col("cat").alias("category"),
    )
    assert out.columns == columns(RAW_POSTS)
    return out


def raw_geo(src: DataFrame) -> DataFrame:
    k = F.col("k")
    out = src.select(
        k.alias("ind"),
        F.when(k % 37 == 0, F.concat(_s(_shift_years(F.col("d"), 21).cast("date")), F.lit("T22:30:00-05:00")))
         .otherwise(_s(_shift_years(F.col("d"), 21))).alias("timestamp"),
        ((k * 7919 % 18001).cast("double") / 100 - 90).alias("latitude"),
        ((k * 104729 % 36001).cast("double") / 100 - 180).alias("longitude"),
        F.col("n_name").alias("country"),
    )
    assert out.columns == columns(RAW_GEO)
    return out


def raw_users(src: DataFrame) -> DataFrame:
    k, ck, d = F.col("k"), F.col("ck"), F.col("d")
    joined = (F.when(k % 3 == 0, _shift_years(d, 17)).when(k % 3 == 1, _shift_years(d, 18))
               .otherwise(_shift_years(d, 19)))
    out = src.select(
        k.alias("ind"),
        F.when(k % 31 == 0, F.lit(None).cast("string"))
         .otherwise(F.substring(F.col("c_name"), 1, 8)).alias("first_name"),
        F.substring(F.col("c_name"), 10, 9).alias("last_name"),
        F.when(ck % 41 == 0, F.lit(None).cast("int")).otherwise((ck % 60 + 10).cast("int")).alias("age"),
        F.when(k % 43 == 0, F.concat(_s(joined.cast("date")), F.lit("T00:30:00+09:00")))
         .otherwise(_s(joined)).alias("date_joined"),
    )
    assert out.columns == columns(RAW_USERS)
    return out


RAW_BUILDERS = {"posts": raw_posts, "geo": raw_geo, "users": raw_users}


def _spoilt(value: Column, rules: list[tuple[Column, Column]]) -> Column:
    """``value`` as the first rule that holds changes it."""
    out = value
    for test, changed in reversed(rules):
        out = F.when(test, changed).otherwise(out)
    return out


def damaged_posts(posts: DataFrame) -> DataFrame:
    """Raw posts as JSON records in ``value``, some of which cannot be read."""
    k, value = F.col("index"), F.to_json(F.struct("*"))
    rows = posts.select("index", value.alias("value"))
    v = F.col("value")
    return rows.select(_spoilt(v, [
        (k % 47 == 0, F.substring(v, F.lit(1), F.length(v) - 5)),
        (k % 53 == 0, F.regexp_replace(v, '"downloaded":[0-9]+', '"downloaded":"maybe"')),
        (k % 59 == 0, F.lit("")),
        (k % 61 == 0, F.lit("[1,2]")),
        (k % 67 == 0, F.regexp_replace(v, '"index":[0-9]+,', "")),
    ]).alias("value"))


def drifted_records(kind: str, raw: DataFrame) -> DataFrame:
    """Raw rows of ``kind`` as JSON records in ``value``, some of them written to
    another schema than the declared one."""
    key = raw.columns[0]
    k, v = F.col(key), F.col("value")
    rules = {
        "posts": [(k % 7 == 0, F.regexp_replace(v, "^.", '{"lang":"en",')),
                  (k % 9 == 0, F.regexp_replace(v, '"downloaded":([0-9]+)', '"downloaded":"$1"'))],
        "geo": [(k % 8 == 0, F.regexp_replace(v, '"latitude":[^,]+,', "")),
                (k % 5 == 0, F.regexp_replace(v, '"longitude":([^,]+),', '"longitude":[$1],'))],
        "users": [(k % 6 == 0, F.regexp_replace(v, "^.", '{"tags":{"a":1},')),
                  (k % 11 == 0, F.regexp_replace(v, '"ind":([0-9]+)', '"ind":$1.5'))],
    }
    return raw.select(key, F.to_json(F.struct("*")).alias("value")).select(_spoilt(v, rules[kind]).alias("value"))
