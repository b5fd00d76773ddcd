"""Cleaning pipelines: schema, values and plan shape."""

import datetime as dt

from postlake.operators.clean import clean_geo, clean_posts, clean_users
from postlake.schemas import CLEAN_GEO, CLEAN_POSTS, CLEAN_USERS, RAW_GEO, RAW_POSTS, RAW_USERS, columns


def raw_posts(spark):
    rows = [
        (1, "u1", "No Title Data Available", "No description available Story format", "User Info Error",
         "5k", "N,o, ,T,a,g,s, ,A,v,a,i,l,a,b,l,e", "multi-video(story page format)", "Image src error.",
         1, "Local save in /data/x", "art"),
        (2, "u2", "", "", "", "", "", "", "", 0, "/y", "travel"),
        (3, "u3", "t", "d", "p", "3M", "a,b", "image", "src", None, None, None),
    ]
    return spark.createDataFrame(rows, RAW_POSTS)


def test_clean_posts(spark):
    out = clean_posts(raw_posts(spark))
    assert out.columns == columns(CLEAN_POSTS)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in CLEAN_POSTS.fields]
    rows = {r.ind: r for r in out.collect()}
    r1 = rows[1]
    assert (r1.title, r1.description, r1.poster_name, r1.tag_list, r1.is_image_or_video, r1.image_src) == (None,) * 6
    assert r1.follower_count == 5000 and r1.save_location == "/data/x" and r1.category == "art"
    r2 = rows[2]
    assert (r2.title, r2.description, r2.poster_name, r2.follower_count, r2.tag_list) == (None,) * 5
    assert rows[3].follower_count == 3000000 and rows[3].title == "t"


def test_clean_posts_stays_in_the_jvm(spark):
    plan = clean_posts(raw_posts(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    udf_plan = clean_posts(raw_posts(spark), use_udf=True)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in udf_plan


def test_clean_posts_udf_agrees(spark):
    a = sorted(clean_posts(raw_posts(spark)).collect(), key=repr)
    b = sorted(clean_posts(raw_posts(spark), use_udf=True).collect(), key=repr)
    assert a == b


def test_clean_geo(spark):
    raw = spark.createDataFrame([(1, "2020-01-02 03:04:05", 1.5, -2.25, "France"),
                                 (2, "not a time", None, 3.0, None)], RAW_GEO)
    out = clean_geo(raw)
    assert out.columns == columns(CLEAN_GEO)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in CLEAN_GEO.fields]
    rows = {r.ind: r for r in out.collect()}
    assert rows[1].coordinates == [1.5, -2.25] and rows[1].timestamp == dt.datetime(2020, 1, 2, 3, 4, 5)
    assert rows[2].coordinates == [None, 3.0] and rows[2].timestamp is None


def test_clean_users(spark):
    raw = spark.createDataFrame([(1, "Ann", "Lee", 30, "2016-05-01 10:00:00"),
                                 (2, None, "Lee", None, "bad"),
                                 (3, None, None, 18, None)], RAW_USERS)
    out = clean_users(raw)
    assert out.columns == columns(CLEAN_USERS)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in CLEAN_USERS.fields]
    rows = {r.ind: r for r in out.collect()}
    assert rows[1].user_name == "Ann Lee" and rows[1].date_joined == dt.datetime(2016, 5, 1, 10)
    assert rows[2].user_name == "Lee" and rows[2].age is None and rows[2].date_joined is None
    assert rows[3].user_name == ""


def test_batch_json_inference_path(spark, tmp_path):
    """Raw JSON read with inference (columns sorted, ints as bigint) cleans the same."""
    raw = raw_posts(spark)
    path = str(tmp_path / "posts")
    raw.write.json(path)
    inferred = spark.read.json(path)
    assert sorted(clean_posts(inferred).collect(), key=repr) == sorted(clean_posts(raw).collect(), key=repr)
