"""The lake: clean tables written once as Parquet and read by every question.

Cleaning runs once per session and test-data directory; the questions then
scan columnar files, so column pruning and filter pushdown reach the disk.
Files go under the shared ``spark.checkpoint.dir`` (see
:func:`postlake.session.scratch_path`), never a machine-local folder.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators import skew_join
from postlake.operators.clean import CLEANERS
from postlake.operators.decode import to_records
from postlake.plans.questions import follower_sketches
from postlake.session import scratch_path
from postlake.sinks.files import write_topic
from postlake.sources.testdata import RAW_BUILDERS, damaged_posts, source_rows
from postlake.streaming.record_log import append_records

TABLES = ("posts", "geo", "users")

# The column the year filters use.  The table is partitioned by its year (column
# ``<name>_year``), so a year filter opens only those folders, and rows are
# sorted by it inside each file, so the pushed-down ranges skip row groups.  Rows
# are first rebalanced on the year: AQE puts small years together and splits
# large ones at the advisory size, so a year has files of about that size,
# however many tasks the input has (tasks times years small files otherwise).
CLUSTER_BY = {"geo": "timestamp", "users": "date_joined"}


def write_clean(clean: DataFrame, name: str, path: str) -> DataFrame:
    """Write a clean table in the lake's layout and read it back."""
    column = CLUSTER_BY.get(name)
    if column is None:
        clean.write.mode("overwrite").parquet(path)
    else:
        year = f"{column}_year"
        (clean.withColumn(year, F.year(column)).hint("rebalance", year).sortWithinPartitions(year, column)
              .write.mode("overwrite").partitionBy(year).parquet(path))
    schema = clean.schema if column is None else clean.withColumn(f"{column}_year", F.year(column)).schema
    return clean.sparkSession.read.schema(schema).parquet(path)


class Lake:
    """The derived source rows (written once), raw tables (lazy projections
    of them) and clean tables (materialised on first use).

    The source rows come from one join of the test-data tables; writing them
    once means the join and its shuffles run once, not once per raw table.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        digest = hashlib.sha1(os.path.abspath(self.sf_dir).encode()).hexdigest()[:12]
        self.root = scratch_path(spark, "lake", digest)
        self._clean: dict[str, DataFrame] = {}
        self._locks = {name: threading.Lock() for name in TABLES}
        self._source_lock = threading.Lock()
        self._source: DataFrame | None = None
        self._records: dict[str, str] = {}
        self._summaries: dict[str, tuple[dict, int]] = {}
        self._sketches: DataFrame | None = None
        self._topics: set[str] = set()
        self._csv: set[str] = set()

    def source(self) -> DataFrame:
        with self._source_lock:
            if self._source is None:
                path = f"{self.root}/source"
                source_rows(self.spark, self.sf_dir).write.mode("overwrite").parquet(path)
                self._source = self.spark.read.parquet(path)
            return self._source

    def raw(self, name: str) -> DataFrame:
        return RAW_BUILDERS[name](self.source())

    def records(self, name: str) -> str:
        """Record log with the JSON records of ``name`` (a stream's input),
        written once."""
        with self._locks[name]:
            if name not in self._records:
                path = f"{self.root}/records-{uuid.uuid4().hex[:10]}/{name}"  # a log is only appended to
                append_records(to_records(self.raw(name)), path)
                self._records[name] = path
            return self._records[name]

    def damaged(self) -> str:
        """Record log of posts, some of which cannot be read, written once."""
        with self._source_lock:
            path = self._records.get("damaged")
        if path is None:
            posts = self.raw("posts")
            with self._source_lock:
                if "damaged" not in self._records:
                    path = f"{self.root}/records-{uuid.uuid4().hex[:10]}/damaged"
                    append_records(damaged_posts(posts), path)
                    self._records["damaged"] = path
                path = self._records["damaged"]
        return path

    def key_summary(self, name: str) -> tuple[dict, int]:
        """The frequent keys of a clean table and its number of rows, from a
        summary kept beside the table (written once)."""
        table = self.clean(name)
        with self._locks[name]:
            if name not in self._summaries:
                path = f"{self.root}/{name}-keys"
                skew_join.key_summary(table, "ind").write.mode("overwrite").parquet(path)
                self._summaries[name] = skew_join.merge_summaries(self.spark.read.parquet(path))
            return self._summaries[name]

    def follower_sketches(self) -> DataFrame:
        """Sketches of the follower counts of users' posts per age group and join
        year, written once."""
        users, posts = self.users, self.posts
        with self._source_lock:
            if self._sketches is None:
                path = f"{self.root}/follower-sketches"
                follower_sketches(users, posts).write.mode("overwrite").parquet(path)
                self._sketches = self.spark.read.parquet(path)
            return self._sketches

    def topic(self, name: str) -> str:
        """Root of a topic folder with the raw rows of ``name`` as JSON lines,
        written once."""
        with self._locks[name]:
            root = f"{self.root}/topics"
            if name not in self._topics:
                write_topic(self.raw(name), root, name, mode="overwrite")
                self._topics.add(name)
            return root

    def csv(self, table: str) -> str:
        """Folder of a test table as CSV with a header, written once."""
        with self._source_lock:
            path = f"{self.root}/csv/{table}"
            if table not in self._csv:
                (self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
                     .write.mode("overwrite").option("header", "true").csv(path))
                self._csv.add(table)
            return path

    def clean(self, name: str) -> DataFrame:
        return self._build_one(name)

    def build(self) -> "Lake":
        """Write all clean tables; the three jobs are independent and run
        concurrently, sharing the cluster's slots."""
        self.source()
        with ThreadPoolExecutor(max_workers=len(TABLES)) as pool:
            list(pool.map(self._build_one, TABLES))
        return self

    def _build_one(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._clean:
                path = f"{self.root}/{name}"
                self._clean[name] = write_clean(CLEANERS[name](self.raw(name)), name, path)
            return self._clean[name]

    @property
    def posts(self) -> DataFrame:
        return self.clean("posts")

    @property
    def geo(self) -> DataFrame:
        return self.clean("geo")

    @property
    def users(self) -> DataFrame:
        return self.clean("users")


_LAKES: dict[tuple[str, str], Lake] = {}
_LAKES_LOCK = threading.Lock()


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The session's lake for ``sf_dir`` (created on first call)."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    with _LAKES_LOCK:
        if key not in _LAKES:
            _LAKES[key] = Lake(spark, sf_dir)
        return _LAKES[key]
