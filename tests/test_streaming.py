"""Streams: batch = stream, restart semantics, separate checkpoints, start time."""

import datetime as dt
import os
import time

import pytest

from postlake.operators.clean import clean_users
from postlake.operators.decode import to_records
from postlake.schemas import RAW_USERS
from postlake.streaming.streams import read_stream, start_clean_stream, start_options


def batch(spark, start, n):
    rows = [(i, f"F{i}", f"L{i}", 18 + i % 50, f"2016-01-{1 + i % 28:02d} 00:00:00") for i in range(start, start + n)]
    return spark.createDataFrame(rows, RAW_USERS)


def run(spark, kind, source, table, ckpt, out, **kw):
    q = start_clean_stream(spark, kind, source, table, ckpt, path=out, **kw)
    q.awaitTermination()
    assert q.exception() is None
    return spark.read.parquet(out)


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    src, ckpt, out = str(tmp_path / "src"), str(tmp_path / "ckpt"), str(tmp_path / "out")
    first = batch(spark, 0, 50)
    to_records(first).write.text(f"{src}/a")
    got = run(spark, "users", f"{src}/*", "t_users_a", ckpt, out)
    assert sorted(got.collect(), key=repr) == sorted(clean_users(first).collect(), key=repr)
    # rerun on the same checkpoint: nothing new, nothing repeated
    assert run(spark, "users", f"{src}/*", "t_users_a", ckpt, out).count() == 50
    # new files: exactly their rows are added
    to_records(batch(spark, 50, 20)).write.text(f"{src}/b")
    assert run(spark, "users", f"{src}/*", "t_users_a", ckpt, out).count() == 70


def test_shared_checkpoint_is_rejected(spark, tmp_path):
    src, ckpt = str(tmp_path / "src"), str(tmp_path / "ckpt")
    to_records(batch(spark, 0, 5)).write.text(src)
    run(spark, "users", src, "t_users_b", ckpt, str(tmp_path / "o1"))
    # nothing is remembered in the process: the name is read from beside the checkpoint
    assert (tmp_path / "ckpt.owner").read_text() == "t_users_b"
    with pytest.raises(ValueError, match="t_users_b"):
        start_clean_stream(spark, "users", src, "t_users_c", ckpt, path=str(tmp_path / "o2"))
    (tmp_path / "ckpt.owner").rename(tmp_path / "moved")  # a checkpoint used by something else
    (tmp_path / ".ckpt.owner.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError, match="has been used"):
        start_clean_stream(spark, "users", src, "t_users_c", ckpt, path=str(tmp_path / "o2"))


def test_start_at_skips_older_files(spark, tmp_path):
    src = str(tmp_path / "src")
    to_records(batch(spark, 0, 5)).write.text(f"{src}/old")
    for root, _, files in os.walk(f"{src}/old"):
        for f in files:
            os.utime(os.path.join(root, f), (time.time() - 3600, time.time() - 3600))
    to_records(batch(spark, 5, 7)).write.text(f"{src}/new")
    start = dt.datetime.now() - dt.timedelta(minutes=10)
    got = run(spark, "users", f"{src}/*", "t_users_d", str(tmp_path / "ck"), str(tmp_path / "out"),
              start_at=start)
    assert sorted(r.ind for r in got.collect()) == list(range(5, 12))


def test_read_stream_payload_is_binary(spark, tmp_path):
    src = str(tmp_path / "src")
    to_records(batch(spark, 0, 2)).write.text(src)
    df = read_stream(spark, src)
    assert df.isStreaming and df.dtypes == [("data", "binary")]


def test_start_options_by_format():
    at = dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)
    assert start_options("kafka", at) == {"startingTimestamp": "1704164645000"}
    assert start_options("kinesis", at) == {
        "initialPosition": '{"at_timestamp": "01/02/2024 03:04:05 UTC", "format": "MM/dd/yyyy HH:mm:ss ZZZ"}'}
    assert start_options("text", at) == start_options("rate", None) == {}
    with pytest.raises(ValueError, match="rate"):
        start_options("rate", at)

