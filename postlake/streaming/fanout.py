"""One query that fans three record streams out to three tables, exactly once.

All sources are read by one streaming query, so one checkpoint holds all their
positions and one start (or restart) moves them together.  Every micro-batch is
written to each table as a folder ``batch=<id>``, overwriting what a failed try
left there; then one ledger file for the batch is put in place by a rename.  A
batch counts once its ledger file is there: readers take only folders of such
batches, and a rerun skips them.  Stopping anywhere, also between two tables,
therefore repeats no row and loses none.

Batch ids run without gaps and belong to the checkpoint, so the ledger lies
beside it and its tables are kept with it: another set of tables is refused.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.streaming.streams import check_owner, claim, clean_stream, read_stream

BATCH = "batch"


class Ledger:
    """``<checkpoint>.ledger/<batch id>.json``: rows per table of each batch done."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.root = checkpoint.rstrip("/") + ".ledger"
        self.fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _file(self, batch: int):
        return self._path(f"{self.root}/{batch:012d}.json")

    def done(self, batch: int) -> bool:
        return self.fs.exists(self._file(batch))

    def record(self, batch: int, counts: dict[str, int]) -> None:
        tried = self._path(f"{self.root}/_{batch:012d}.tmp")
        out = self.fs.create(tried, True)
        out.write(bytearray(json.dumps(counts).encode()))
        out.close()
        if not self.fs.rename(tried, self._file(batch)):
            raise OSError(f"batch {batch} could not be entered in {self.root}")

    def last(self) -> int:
        """The last batch done, -1 if none."""
        root = self._path(self.root)
        if not self.fs.exists(root):
            return -1
        names = [f.getPath().getName() for f in self.fs.listStatus(root)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("_")), default=-1)


def write_table(rows: DataFrame, table: str, batch: int) -> int:
    """Write one batch of one table, replacing a failed try; the rows written."""
    path = f"{table.rstrip('/')}/{BATCH}={batch}"
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).count()  # footers only


def _write_batch(df: DataFrame, batch: int, tables: dict[str, str], ledger: Ledger, drop_malformed: bool) -> None:
    if ledger.done(batch):
        return
    df.persist()  # the sources are read once for all tables
    try:
        counts = {}
        for kind, table in tables.items():
            records = df.where(F.col("kind") == kind).select("data")
            counts[kind] = write_table(clean_stream(records, kind, drop_malformed), table, batch)
        ledger.record(batch, counts)
    finally:
        df.unpersist()


def start_fanout(spark: SparkSession, sources: dict[str, str], tables: dict[str, str], checkpoint: str,
                 source_fmt: str = "record_log", drop_malformed: bool = False, available_now: bool = True,
                 **source) -> StreamingQuery:
    """Start (or resume) the query: ``sources`` and ``tables`` give a path for
    each kind (posts, geo, users).  ``source`` goes to :func:`read_stream`
    (``start_at``, ``options``, ``payload``)."""
    if set(sources) != set(tables) or not sources:
        raise ValueError("sources and tables must name the same kinds")
    owner = json.dumps(dict(sorted(tables.items())))
    check_owner(spark, checkpoint, owner, by_path=True)
    streams = [read_stream(spark, path, source_fmt, **source).withColumn("kind", F.lit(kind))
               for kind, path in sorted(sources.items())]
    df = streams[0]
    for other in streams[1:]:
        df = df.unionByName(other)
    ledger = Ledger(spark, checkpoint)
    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda rows, batch: _write_batch(rows, batch, tables, ledger, drop_malformed))
    query = (writer.trigger(availableNow=True) if available_now else writer).start()
    claim(spark, checkpoint, owner)
    return query


def read_fanout(spark: SparkSession, table: str, checkpoint: str, schema=None) -> DataFrame:
    """The rows of the batches that are done; others are not opened."""
    last = Ledger(spark, checkpoint).last()
    if last < 0:
        if schema is None:
            raise ValueError(f"no batch is done yet in {checkpoint!r}; give the schema to read an empty table")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", table)
    df = reader.parquet(table)
    return df.where(F.col(BATCH) <= last).drop(BATCH)
