"""The record log: sequence numbers, start inside a file, resume at the record."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from postlake.operators.clean import clean_users
from postlake.operators.decode import to_records
from postlake.schemas import RAW_USERS
from postlake.streaming import record_log
from postlake.streaming.record_log import Log, append_records
from postlake.streaming.streams import read_stream, start_clean_stream

T0 = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)


def users(spark, start, n):
    rows = [(i, f"F{i}", f"L{i}", 18 + i % 50, f"2016-01-{1 + i % 28:02d} 00:00:00") for i in range(start, start + n)]
    return spark.createDataFrame(rows, RAW_USERS)


def append(spark, path, start, n, tasks=1, shards=1):
    """Records ``start`` on, one a second after T0."""
    recs = to_records(users(spark, start, n).coalesce(1).withColumn("ind", F.col("ind")))
    recs = recs.withColumn("ind", F.get_json_object("value", "$.ind").cast("long"))
    if tasks > 1:
        recs = recs.repartitionByRange(tasks, "ind").sortWithinPartitions("ind")
    append_records(recs, path, F.timestamp_seconds(F.lit(int(T0.timestamp())) + F.col("ind")), shards=shards)


def read(spark, path, **options):
    record_log.register(spark)
    return spark.read.format("record_log").options(**options).load(path)


def inds(df):
    return sorted(json.loads(bytes(r.data))["ind"] for r in df.collect())


def test_numbers_have_no_gaps_and_appends_continue(spark, tmp_path):
    log = str(tmp_path / "log")
    append(spark, log, 0, 30, tasks=3, shards=2)
    append(spark, log, 30, 11, tasks=2, shards=2)
    rows = read(spark, log).collect()
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.seq)
    assert len(rows) == 41 and set(by_shard) == {0, 1}
    assert all(sorted(seqs) == list(range(len(seqs))) for seqs in by_shard.values())
    assert inds(read(spark, log)) == list(range(41))
    assert inds(read(spark, log, rowsPerTask="4")) == list(range(41))


def test_an_append_without_its_index_is_not_there(spark, tmp_path):
    log = str(tmp_path / "log")
    append(spark, log, 0, 10)
    append(spark, log, 10, 10)
    os.remove(tmp_path / "log" / "index" / "000000000001.json")  # as if the job had died before its commit
    assert inds(read(spark, log)) == list(range(10))
    append(spark, log, 50, 5)
    assert inds(read(spark, log)) == list(range(10)) + list(range(50, 55))
    with pytest.raises(Exception, match="only appended"):
        users(spark, 0, 1).select(F.current_timestamp().alias("arrived"), F.lit(b"x").alias("data")) \
            .write.format("record_log").mode("overwrite").save(log)


def test_start_and_end_cut_inside_a_file(spark, tmp_path):
    log = str(tmp_path / "log")
    append(spark, log, 0, 20)
    assert len(Log(log).fs.get_file_info(record_log.arrow_fs.FileSelector(log + "/segments"))) == 1
    at = lambda s: (T0 + dt.timedelta(seconds=s)).isoformat()
    assert inds(read(spark, log, startAt=at(7))) == list(range(7, 20))
    assert inds(read(spark, log, endAt=at(7))) == list(range(7))
    assert inds(read(spark, log, startAt=at(3), endAt=at(5))) == [3, 4]
    assert inds(read(spark, log, startAt=at(99))) == []


def run(spark, log, tmp_path, name, **kw):
    out = str(tmp_path / "out")
    q = start_clean_stream(spark, "users", log, f"t_log_{name}", str(tmp_path / "ckpt"), path=out, source_fmt="record_log", **kw)
    q.awaitTermination()
    assert q.exception() is None
    return spark.read.parquet(out)


def test_stream_starts_inside_a_file_and_resumes_at_the_record(spark, tmp_path):
    log = str(tmp_path / "log")
    append(spark, log, 0, 40)
    until = {"endAt": (T0 + dt.timedelta(seconds=25)).isoformat()}
    first = run(spark, log, tmp_path, "a", start_at=T0 + dt.timedelta(seconds=12), source_options=until)
    assert sorted(r.ind for r in first.collect()) == list(range(12, 25))
    # the same file goes on at record 25; a new append follows
    append(spark, log, 40, 5)
    rest = run(spark, log, tmp_path, "a", start_at=T0 + dt.timedelta(seconds=12))
    assert sorted(r.ind for r in rest.collect()) == list(range(12, 45))
    assert run(spark, log, tmp_path, "a").count() == 33  # nothing new, nothing repeated
    expected = clean_users(users(spark, 12, 33)).collect()
    assert sorted(rest.collect(), key=repr) == sorted(expected, key=repr)
    offsets = sorted(os.listdir(tmp_path / "ckpt" / "offsets"))
    with open(tmp_path / "ckpt" / "offsets" / [o for o in offsets if o.isdigit()][0]) as f:
        assert '{"0": 25}' in f.read()


def test_a_batch_that_failed_is_read_again_from_its_first_record(spark, tmp_path):
    log, seen = str(tmp_path / "log"), []
    append(spark, log, 0, 15)

    def once(df, batch):
        seen.append((batch, inds(df)))
        if len(seen) == 1:
            raise RuntimeError("stopped")

    for _ in range(3):
        q = read_stream(spark, log, "record_log").writeStream.option("checkpointLocation", str(tmp_path / "c")) \
            .foreachBatch(once).trigger(availableNow=True).start()
        try:
            q.awaitTermination()
        except StreamingQueryException:
            append(spark, log, 15, 5)
    assert seen[0] == seen[1] == (0, list(range(15)))
    assert seen[2] == (1, list(range(15, 20)))


def test_empty_log_and_nulls(spark, tmp_path):
    log = str(tmp_path / "log")
    assert read(spark, log).count() == 0
    rows = spark.createDataFrame([(None, None), (None, "x")], "arrived timestamp, value string").coalesce(1)
    append_records(rows, log, F.col("arrived"), shards=1)
    got = read(spark, log).orderBy("seq").collect()
    assert [(r.seq, r.arrived, r.data and bytes(r.data)) for r in got] == [(0, None, None), (1, None, b"x")]
    assert read(spark, log, startAt="2020-01-01").count() == 0
