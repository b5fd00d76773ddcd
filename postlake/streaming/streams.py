"""Streams of byte records -> decode -> clean -> append-only table.

Each stream is stateless (a projection per micro-batch), so it scales with
the source's partitions and keeps no state store.  The record log
(:mod:`postlake.streaming.record_log`) or text files stand in for Kinesis / Kafka
here; the format and its options are parameters, and the start position and
payload column follow the format.  Every stream has its own
checkpoint; its table's name is kept beside it, so reusing one for a second
table is rejected in any session.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.operators.clean import CLEANERS
from postlake.operators.decode import decode
from postlake.schemas import RAW
from postlake.streaming import record_log

FILE_FORMATS = frozenset(("text", "json", "csv", "parquet", "orc", "binaryFile"))
# Column that carries a record's bytes, by format; ``value`` for others.
PAYLOADS = {"kinesis": "data", record_log.FORMAT: "data"}


def start_options(fmt: str, start_at: dt.datetime | None) -> dict[str, str]:
    """Reader options that skip records older than ``start_at``.

    Kafka takes ``startingTimestamp`` in milliseconds, Kinesis
    ``initialPosition`` with a time, the record log ``startAt``.  File sources
    take none: their files are filtered by modification time.  Other formats
    have no start time.
    """
    if start_at is None or fmt in FILE_FORMATS:
        return {}
    if fmt == "kafka":
        return {"startingTimestamp": str(int(start_at.timestamp() * 1000))}
    if fmt == record_log.FORMAT:
        return {"startAt": start_at.astimezone(dt.timezone.utc).isoformat()}
    if fmt == "kinesis":
        moment = start_at.astimezone(dt.timezone.utc).strftime("%m/%d/%Y %H:%M:%S UTC")
        return {"initialPosition": json.dumps({"at_timestamp": moment, "format": "MM/dd/yyyy HH:mm:ss ZZZ"})}
    raise ValueError(f"format {fmt!r} has no start time; leave start_at out or pass the source's own options")


def read_stream(spark: SparkSession, path: str | None = None, fmt: str = "text",
                payload: str | None = None, start_at: dt.datetime | None = None,
                options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of records with one binary ``data`` column.

    ``payload`` is the source column with the record (default by format, see
    ``PAYLOADS``); ``start_at`` skips records that arrived earlier, see
    :func:`start_options`.
    """
    if fmt == record_log.FORMAT:
        record_log.register(spark)
    reader = spark.readStream.format(fmt).options(**start_options(fmt, start_at))
    if options:
        reader = reader.options(**options)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load() if path is None else reader.load(path)
    if start_at is not None and fmt in FILE_FORMATS:
        df = df.where(F.col("_metadata.file_modification_time") >= F.lit(start_at))
    return df.select(F.col(payload or PAYLOADS.get(fmt, "value")).cast("binary").alias("data"))


def _owner_file(spark: SparkSession, checkpoint: str):
    """The file beside a checkpoint that names its table, and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint.rstrip("/") + ".owner")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def check_owner(spark: SparkSession, checkpoint: str, table: str, by_path: bool = False) -> None:
    """Refuse a checkpoint that another table has used: its stream would take
    the other's records as done and leave ``table`` empty.  ``by_path``: the
    tables are folders, not names in the catalogue."""
    path, fs = _owner_file(spark, checkpoint)
    if fs.exists(path):
        owner = spark.read.text(path.toString()).first()[0]
        if owner != table:
            raise ValueError(f"checkpoint {checkpoint!r} already belongs to table {owner!r}")
        return
    commits = spark._jvm.org.apache.hadoop.fs.Path(checkpoint.rstrip("/") + "/commits")
    if fs.exists(commits) and (by_path or not spark.catalog.tableExists(table)):
        raise ValueError(f"checkpoint {checkpoint!r} has been used, and there is no table {table!r} yet")


def claim(spark: SparkSession, checkpoint: str, table: str) -> None:
    """Keep the table's name beside the checkpoint, once its stream has started."""
    path, fs = _owner_file(spark, checkpoint)
    if not fs.exists(path):
        out = fs.create(path, False)
        out.write(bytearray(table.encode()))
        out.close()


def append_stream(df: DataFrame, table: str, checkpoint: str, fmt: str = "parquet",
                  path: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Append a stream to ``table``; ``path`` makes it an external table there.

    ``available_now`` processes what has arrived and stops, so a scheduled
    rerun picks up only new records (the checkpoint remembers the rest).
    """
    check_owner(df.sparkSession, checkpoint, table)
    writer = (df.writeStream.format(fmt).outputMode("append")
                .option("checkpointLocation", checkpoint))
    if path is not None:
        writer = writer.option("path", path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    query = writer.toTable(table)
    claim(df.sparkSession, checkpoint, table)
    return query


def clean_stream(records: DataFrame, kind: str, drop_malformed: bool = False) -> DataFrame:
    """Decode payloads with the raw schema of ``kind`` and clean them."""
    return CLEANERS[kind](decode(records, RAW[kind], "data", drop_malformed))


def start_clean_stream(spark: SparkSession, kind: str, source: str | None, table: str, checkpoint: str,
                       path: str | None = None, fmt: str = "parquet", source_fmt: str = "text",
                       start_at: dt.datetime | None = None, source_options: dict | None = None,
                       drop_malformed: bool = False, payload: str | None = None) -> StreamingQuery:
    """posts / geo / users: source -> decode -> clean -> append to ``table``."""
    records = read_stream(spark, source, source_fmt, payload, start_at, source_options)
    return append_stream(clean_stream(records, kind, drop_malformed), table, checkpoint, fmt, path)


def stream_posts(spark: SparkSession, source: str, table: str, checkpoint: str, **kw) -> StreamingQuery:
    """Posts stream: records -> decode -> :func:`clean_posts` -> ``table``."""
    return start_clean_stream(spark, "posts", source, table, checkpoint, **kw)


def stream_geo(spark: SparkSession, source: str, table: str, checkpoint: str, **kw) -> StreamingQuery:
    """Geolocation stream: records -> decode -> :func:`clean_geo` -> ``table``."""
    return start_clean_stream(spark, "geo", source, table, checkpoint, **kw)


def stream_users(spark: SparkSession, source: str, table: str, checkpoint: str, **kw) -> StreamingQuery:
    """Users stream: records -> decode -> :func:`clean_users` -> ``table``."""
    return start_clean_stream(spark, "users", source, table, checkpoint, **kw)
