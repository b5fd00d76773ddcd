"""A partitioned record log as a Spark data source: ``format("record_log")``.

The log stands in for a sharded stream service on a shared folder.  Each record
has a shard, a sequence number without gaps in its shard, the time it arrived,
and a byte payload.  A stream's offset is the next sequence number of every
shard, kept in the query's checkpoint, so a run starts and stops between any
two records, also inside a file.

Layout: ``segments/*.parquet`` (one file a write task, rows in order) and
``index/<append>.json`` (which segments the append added, their shard, first
sequence number, row count and arrival range).  An append is there once its
index file is; what an aborted one wrote is never listed.  The driver reads each
index file once: one line a segment, no rows.  One writer at a time.

The reader is Python because Spark has no public file source with offsets inside
files; rows pass as Arrow batches, one task a slice of a segment.
"""

from __future__ import annotations

import datetime as dt
import json
import posixpath
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader,
                                    InputPartition, WriterCommitMessage)
from pyspark.sql.types import StructType

FORMAT = "record_log"
SCHEMA = "shard int, seq long, arrived timestamp, data binary"
_ARROW = pa.schema([("shard", pa.int32()), ("seq", pa.int64()), ("arrived", pa.timestamp("us", "UTC")), ("data", pa.binary())])
_SEGMENT = pa.schema([_ARROW.field("arrived"), _ARROW.field("data")])


@dataclass
class Segment:
    """One file: records ``base`` to ``base + rows - 1`` of ``shard``; arrival
    times in microseconds since 1970, ``None`` where no record has one."""

    file: str
    shard: int
    base: int
    rows: int
    first: int | None
    last: int | None


@dataclass
class Written(WriterCommitMessage):
    task: int
    file: str
    rows: int
    first: int | None
    last: int | None


class Slice(InputPartition):
    """Rows ``lo`` to ``hi`` (excluded) of a segment."""

    def __init__(self, segment: Segment, lo: int, hi: int):
        super().__init__((segment.file, lo, hi))
        self.segment, self.lo, self.hi = segment, lo, hi


def _micros(moment: str | None) -> int | None:
    if not moment:
        return None
    at = dt.datetime.fromisoformat(moment)
    at = at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)
    return (at - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


class Log:
    """The folder of a log, seen through pyarrow's file systems."""

    def __init__(self, path: str):
        self.fs, self.root = arrow_fs.FileSystem.from_uri(path)
        self.seen: dict[str, list[Segment]] = {}

    def file(self, *parts: str) -> str:
        return posixpath.join(self.root, *parts)

    def refresh(self) -> None:
        """Read the index files that are new."""
        listing = self.fs.get_file_info(arrow_fs.FileSelector(self.file("index"), allow_not_found=True))
        for info in sorted(listing, key=lambda i: i.base_name):
            if info.base_name.endswith(".json") and info.base_name not in self.seen:
                with self.fs.open_input_stream(info.path) as f:
                    self.seen[info.base_name] = [Segment(**s) for s in json.loads(f.read())]

    def segments(self) -> list[Segment]:
        return [s for name in sorted(self.seen) for s in self.seen[name]]

    def ends(self) -> dict[int, int]:
        """The next sequence number of every shard."""
        out: dict[int, int] = {}
        for s in self.segments():
            out[s.shard] = max(out.get(s.shard, 0), s.base + s.rows)
        return out

    def offsets_at(self, moment: int) -> dict[int, int]:
        """Per shard the first record that arrived at ``moment`` or later; its
        end if there is none.  Opens one segment a shard, arrivals only."""
        out = self.ends()
        found: set[int] = set()
        for s in sorted(self.segments(), key=lambda s: (s.shard, s.base)):
            if s.shard not in found and s.last is not None and s.last >= moment:
                found.add(s.shard)
                out[s.shard] = s.base + self._row_at(s, moment)
        return out

    def _row_at(self, segment: Segment, moment: int) -> int:
        row = 0
        with self.fs.open_input_file(self.file("segments", segment.file)) as f:
            for batch in pq.ParquetFile(f).iter_batches(columns=["arrived"]):
                late = pc.index(pc.greater_equal(batch.column(0).cast(pa.int64()), moment), True).as_py()
                if late >= 0:
                    return row + late
                row += batch.num_rows
        return segment.rows

    def rows(self, segment: Segment, lo: int, hi: int) -> Iterator[pa.RecordBatch]:
        """Rows ``lo`` to ``hi`` of a segment; row groups outside are not read."""
        with self.fs.open_input_file(self.file("segments", segment.file)) as f:
            parquet = pq.ParquetFile(f)
            start = 0
            for g in range(parquet.num_row_groups):
                end = start + parquet.metadata.row_group(g).num_rows
                if start < hi and end > lo:
                    at = start
                    for batch in parquet.iter_batches(batch_size=8192, row_groups=[g]):
                        a, b = max(lo - at, 0), min(hi - at, batch.num_rows)
                        if a < b:
                            part = batch.slice(a, b - a)
                            seq = pa.array(range(segment.base + at + a, segment.base + at + b), pa.int64())
                            shard = pa.array([segment.shard] * (b - a), pa.int32())
                            yield pa.RecordBatch.from_arrays([shard, seq, part.column("arrived"), part.column("data")], schema=_ARROW)
                        at += batch.num_rows
                start = end


class _Reader:
    """Shared by batch and stream: options and slices.

    ``startAt`` / ``endAt`` (ISO times) bound the records by arrival: in every
    shard from the first record that arrived at ``startAt`` or later up to, not
    with, the first that arrived at ``endAt`` or later.  ``rowsPerTask`` is the
    longest slice a task reads.
    """

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.start_at, self.end_at = _micros(options.get("startAt")), _micros(options.get("endAt"))
        self.rows_per_task = int(options.get("rowsPerTask", 1_000_000))
        self.log: Log | None = None

    def opened(self) -> Log:
        self.log = self.log or Log(self.path)
        self.log.refresh()
        return self.log

    def first(self) -> dict[str, int]:
        log = self.opened()
        if self.start_at is None:
            return {str(s): 0 for s in log.ends()}
        return {str(s): n for s, n in log.offsets_at(self.start_at).items()}

    def last(self) -> dict[str, int]:
        log = self.opened()
        ends = log.ends() if self.end_at is None else log.offsets_at(self.end_at)
        return {str(s): n for s, n in ends.items()}

    def slices(self, start: dict[str, int], end: dict[str, int]) -> list[Slice]:
        out = []
        for s in self.opened().segments():
            # a shard that is new since the stream began counts from its first record
            lo, hi = max(s.base, start.get(str(s.shard), 0)), min(s.base + s.rows, end.get(str(s.shard), 0))
            for a in range(lo, hi, self.rows_per_task):
                out.append(Slice(s, a - s.base, min(a + self.rows_per_task, hi) - s.base))
        return out

    def __getstate__(self) -> dict:
        return {**self.__dict__, "log": None}  # file systems stay where they were opened

    def read(self, partition: Slice | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what a batch scan without slices is given
            return
        yield from Log(self.path).rows(partition.segment, partition.lo, partition.hi)


class BatchReader(_Reader, DataSourceReader):
    def partitions(self) -> list[Slice]:
        return self.slices(self.first(), self.last())


class StreamReader(_Reader, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return self.first()

    def latestOffset(self) -> dict:
        return self.last()

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        return self.slices(start, end)


class Writer(DataSourceArrowWriter):
    """Appends (arrived timestamp, data binary) rows in the order of each task.

    ``shards`` is how many shards the log has: the segments of an append are
    dealt to them by task.
    """

    def __init__(self, options: dict[str, str]):
        self.path, self.shards = options["path"], int(options.get("shards", 4))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        context = TaskContext.get()
        log, name, out = Log(self.path), f"{uuid.uuid4().hex}.parquet", None
        rows, first, last = 0, None, None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                log.fs.create_dir(log.file("segments"), recursive=True)
                out = pq.ParquetWriter(log.file("segments", name), _SEGMENT, filesystem=log.fs)
            batch = pa.RecordBatch.from_arrays([batch.column("arrived").cast(_SEGMENT.field(0).type),
                                                batch.column("data").cast(pa.binary())], schema=_SEGMENT)
            out.write_batch(batch)
            times = pc.min_max(batch.column(0).cast(pa.int64())).as_py()
            if times["min"] is not None:
                first = times["min"] if first is None else min(first, times["min"])
                last = times["max"] if last is None else max(last, times["max"])
            rows += batch.num_rows
        if out is not None:
            out.close()
        return Written(context.partitionId() if context else 0, name, rows, first, last)

    def commit(self, messages: list[Written | None]) -> None:
        log = Log(self.path)
        log.refresh()
        ends = log.ends()
        added = []
        for m in sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.task):
            shard = m.task % self.shards
            added.append(Segment(m.file, shard, ends.get(shard, 0), m.rows, m.first, m.last).__dict__)
            ends[shard] = ends.get(shard, 0) + m.rows
        if not added:
            return
        log.fs.create_dir(log.file("index"), recursive=True)
        name = f"{len(log.seen):012d}.json"
        with log.fs.open_output_stream(log.file("index", f"_{name}.tmp")) as f:
            f.write(json.dumps(added).encode())
        log.fs.move(log.file("index", f"_{name}.tmp"), log.file("index", name))  # all or nothing

    def abort(self, messages: list[Written | None]) -> None:
        log = Log(self.path)
        for m in messages:
            if m is not None and m.rows:
                log.fs.delete_file(log.file("segments", m.file))


class RecordLog(DataSource):
    """``spark.read`` / ``readStream`` / ``write.mode("append")`` over a log."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return BatchReader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return StreamReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("a log is only appended to")
        return Writer(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session; again does no harm.  The classes
    travel with the query, so its workers need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    try:
        spark.dataSource.register(RecordLog)
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])


def append_records(records: DataFrame, path: str, arrived=None, payload: str = "value", shards: int = 4) -> None:
    """Append ``records`` to the log at ``path``, each task's rows in order as one
    segment.  ``arrived`` is a timestamp column expression (default: now)."""
    register(records.sparkSession)
    arrived = F.current_timestamp() if arrived is None else arrived
    (records.select(arrived.cast("timestamp").alias("arrived"), F.col(payload).cast("binary").alias("data"))
            .write.format(FORMAT).mode("append").option("shards", str(shards)).save(path))
