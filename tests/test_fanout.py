"""Three streams from one start: stop anywhere, run again, nothing lost or repeated."""

import pytest

from postlake.operators.clean import CLEANERS
from postlake.operators.decode import to_records
from postlake.plans.lake import lake
from postlake.schemas import CLEAN, RAW
from postlake.streaming import fanout
from postlake.streaming.fanout import Ledger, read_fanout, start_fanout
from postlake.streaming.record_log import append_records


@pytest.fixture
def parts(spark, sf_small):
    """Two halves of the raw rows of each kind."""
    lk = lake(spark, sf_small)
    return [{k: lk.raw(k).where(f"{RAW[k][0].name} % 2 = {i}") for k in RAW} for i in (0, 1)]


@pytest.fixture
def paths(tmp_path):
    return ({k: str(tmp_path / "log" / k) for k in RAW}, {k: str(tmp_path / "table" / k) for k in RAW}, str(tmp_path / "ckpt"))


def fill(part, sources, fmt="text"):
    for kind, raw in part.items():
        if fmt == "text":  # quicker to start than the log
            to_records(raw).coalesce(2).write.mode("append").text(sources[kind])
        else:
            append_records(to_records(raw), sources[kind])


def run(spark, sources, tables, checkpoint, fmt="text"):
    q = start_fanout(spark, sources, tables, checkpoint, fmt)
    q.awaitTermination()
    assert q.exception() is None


def check(spark, tables, checkpoint, *parts):
    for kind, table in tables.items():
        raw = parts[0][kind]
        for more in parts[1:]:
            raw = raw.unionByName(more[kind])
        got = sorted(map(repr, read_fanout(spark, table, checkpoint).collect()))
        assert got == sorted(map(repr, CLEANERS[kind](raw).collect()))


def test_runs_add_up(spark, parts, paths):
    sources, tables, checkpoint = paths
    log = "record_log"
    fill(parts[0], sources, log)
    run(spark, sources, tables, checkpoint, log)
    check(spark, tables, checkpoint, parts[0])
    run(spark, sources, tables, checkpoint, log)  # nothing new
    fill(parts[1], sources, log)
    run(spark, sources, tables, checkpoint, log)
    check(spark, tables, checkpoint, *parts)
    assert Ledger(spark, checkpoint).last() == 1


@pytest.mark.parametrize("broken", ["posts", "users", "ledger"])
def test_stop_between_two_tables(spark, parts, paths, monkeypatch, broken):
    sources, tables, checkpoint = paths
    fill(parts[0], sources)
    run(spark, sources, tables, checkpoint)
    fill(parts[1], sources)
    write, record = fanout.write_table, Ledger.record

    def stopping_write(rows, table, batch):
        n = write(rows, table, batch)
        if table == tables.get(broken):
            raise RuntimeError("stopped after a table")
        return n

    def stopping_record(self, batch, counts):
        raise RuntimeError("stopped before the ledger")
    monkeypatch.setattr(fanout, "write_table", stopping_write)
    if broken == "ledger":
        monkeypatch.setattr(Ledger, "record", stopping_record)
    q = start_fanout(spark, sources, tables, checkpoint, "text")
    with pytest.raises(Exception, match="stopped"):
        q.awaitTermination()
    check(spark, tables, checkpoint, parts[0])  # the half-written batch is not seen
    monkeypatch.setattr(fanout, "write_table", write)
    monkeypatch.setattr(Ledger, "record", record)
    run(spark, sources, tables, checkpoint)
    check(spark, tables, checkpoint, *parts)


def test_stop_after_the_ledger(spark, parts, paths, monkeypatch):
    """The ledger is written, the query's own commit is not: the batch comes again and is skipped."""
    sources, tables, checkpoint = paths
    fill(parts[0], sources)
    record = Ledger.record

    def stopping_record(self, batch, counts):
        record(self, batch, counts)
        raise RuntimeError("stopped after the ledger")
    monkeypatch.setattr(Ledger, "record", stopping_record)
    q = start_fanout(spark, sources, tables, checkpoint, "text")
    with pytest.raises(Exception, match="stopped"):
        q.awaitTermination()
    monkeypatch.setattr(Ledger, "record", record)
    monkeypatch.setattr(fanout, "write_table", lambda *a: pytest.fail("written twice"))
    run(spark, sources, tables, checkpoint)
    check(spark, tables, checkpoint, parts[0])


def test_other_tables_and_empty_sources(spark, paths):
    sources, tables, checkpoint = paths
    assert read_fanout(spark, tables["geo"], checkpoint, CLEAN["geo"]).count() == 0
    with pytest.raises(ValueError, match="no batch"):
        read_fanout(spark, tables["geo"], checkpoint)
    run(spark, sources, tables, checkpoint, "record_log")  # no log yet
    assert read_fanout(spark, tables["geo"], checkpoint, CLEAN["geo"]).count() == 0
    with pytest.raises(ValueError, match="belongs"):
        start_fanout(spark, sources, {**tables, "geo": tables["geo"] + "2"}, checkpoint)
    with pytest.raises(ValueError, match="same kinds"):
        start_fanout(spark, sources, {"geo": tables["geo"]}, checkpoint)
