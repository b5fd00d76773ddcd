"""Records, envelopes, JSON topics, CSV and key lookup."""

import pytest

from postlake.operators.decode import decode, to_records, unpack_envelope, wrap_data, wrap_records
from postlake.schemas import RAW_GEO, RAW_USERS
from postlake.sinks.files import register_views, write_topic
from postlake.sources.files import lookup_value, read_csv, read_topic, single_value
from postlake.sources.jdbc import read_jdbc

USERS = [(1, "Ann", "Lee", 30, "2016-05-01 10:00:00"), (2, None, "Lee", None, None),
         (2, "Bo", "Ma", 18, "2019-01-01 00:00:00")]


def users(spark):
    return spark.createDataFrame(USERS, RAW_USERS)


def test_records_round_trip(spark):
    recs = to_records(users(spark))
    assert recs.columns == ["value"]
    text = [r.value for r in recs.collect()]
    assert any('"first_name"' not in t for t in text)  # NULL fields are left out
    back = decode(recs.withColumnRenamed("value", "data"), RAW_USERS, "data")
    assert sorted(back.collect(), key=repr) == sorted(users(spark).collect(), key=repr)


def test_decode_binary_payload_and_malformed(spark):
    rows = [('{"ind": 1, "country": "X", "latitude": 1.5}',), ("not json",), ('{"ind": "oops", "country": "Y"}',)]
    df = spark.createDataFrame(rows, "value string").selectExpr("cast(value as binary) as data")
    out = decode(df, RAW_GEO).collect()
    assert len(out) == 3
    assert out[0].ind == 1 and out[0].latitude == 1.5
    assert all(v is None for v in out[1])
    assert out[2].ind is None and out[2].country == "Y"
    assert len(decode(df, RAW_GEO, drop_malformed=True).collect()) == 2


def test_envelopes(spark):
    df = users(spark)
    rec = unpack_envelope(wrap_records(df), RAW_USERS, "records")
    assert sorted(rec.collect(), key=repr) == sorted(df.collect(), key=repr)
    dat = unpack_envelope(wrap_data(df, "s", "k"), RAW_USERS, "data")
    assert sorted(dat.collect(), key=repr) == sorted(df.collect(), key=repr)
    many = spark.createDataFrame([('{"records":[{"value":{"ind":1}},{"value":{"ind":2}}]}',)], "value string")
    assert [r.ind for r in unpack_envelope(many, RAW_USERS).collect()] == [1, 2]
    with pytest.raises(ValueError):
        unpack_envelope(df, RAW_USERS, "other")


def test_topic_round_trip(spark, tmp_path):
    root = str(tmp_path / "topics")
    write_topic(users(spark), root, "users")
    write_topic(users(spark), root, "users", partition=1)
    assert read_topic(spark, root, "users", RAW_USERS, partition=0).count() == 3
    assert read_topic(spark, root, "users", RAW_USERS).count() == 6
    inferred = read_topic(spark, root, "users")
    assert sorted(inferred.columns) == inferred.columns  # inference sorts by name


def test_csv_and_lookup(spark, tmp_path):
    path = str(tmp_path / "keys")
    spark.createDataFrame([("alice", "AK1", "s/1+"), ("bob", "AK2", "s2")],
                          "`User name` string, `Access key ID` string, `Secret access key` string") \
        .write.option("header", "true").csv(path)
    keys = read_csv(spark, path)
    assert all(t == "string" for _, t in keys.dtypes)
    assert [r[0] for r in lookup_value(keys, "User name", "bob", "Access key ID").collect()] == ["AK2"]
    assert single_value(keys, "User name", "alice", "Secret access key") == "s/1+"
    with pytest.raises(LookupError):
        single_value(keys, "User name", "carol", "Access key ID")
    semi = str(tmp_path / "semi")
    spark.createDataFrame([("a", "1")], "x string, y string").write.option("header", "true") \
        .option("sep", ";").csv(semi)
    assert read_csv(spark, semi, sep=";").columns == ["x", "y"]


def test_register_views(spark):
    df = users(spark)
    register_views(df, df, df)
    assert spark.sql("select count(*) from countries").first()[0] == 3


def test_read_jdbc_needs_bounds(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none", "t", column="ind")


def test_typed_timestamps_round_trip_outside_utc(spark):
    from postlake.operators.clean import clean_users
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        typed = spark.sql("select 1L as ind, 'A' as first_name, 'B' as last_name, 20 as age, timestamp '2018-12-31 23:30:00' as date_joined")
        recs = to_records(typed)
        assert '"date_joined":"2018-12-31 23:30:00"' in recs.first().value
        back = decode(recs.withColumnRenamed("value", "data"), RAW_USERS, "data")
        assert str(clean_users(back).first().date_joined) == "2018-12-31 23:30:00"
        again = unpack_envelope(wrap_records(typed), RAW_USERS)
        assert again.first().date_joined == "2018-12-31 23:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_topic_keeps_the_text_of_bad_lines(spark, tmp_path):
    folder = tmp_path / "users" / "partition=0"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"ind": 1, "age": 30}\nnot json\n')
    rows = read_topic(spark, str(tmp_path), "users", RAW_USERS, corrupt_record="_bad").select("ind", "_bad").collect()
    assert sorted((r.ind or 0, r["_bad"]) for r in rows) == [(0, "not json"), (1, None)]
