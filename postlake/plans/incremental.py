"""Scheduled runs over growing topic folders that read each file once.

A run lists the topics, reads the files that no earlier run has read, and stores
what the counting questions need of them: counts per key and answer column, which
add up over files.  Questions are answered from the stored counts of all runs.

State: ``<state>/<kind>/run=<n>`` (counts, Parquet) and ``<state>/manifest/<n>.json``
(the files of run n, or the runs it stands for after :func:`compact`).  A run
counts once its manifest is there, put in place by a rename; what a failed run
has written is overwritten by the next one, which has the same number.  One run
at a time, as the scheduler starts them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions import age_group
from postlake.operators.clean import CLEANERS
from postlake.operators.joins import joined_weights
from postlake.schemas import RAW
from postlake.sources.files import topic_path

KEY, COUNT = "ind", "n"
#: Per kind, the columns whose counts per key answer the questions.
PARTS = {"geo": ["country", "post_year"], "posts": ["category"], "users": ["age_group", "year_joined"]}


def _counts(kind: str, clean: DataFrame) -> DataFrame:
    """Rows per key and answer columns; rows without a key count too (A5)."""
    if kind == "geo":
        clean = clean.withColumn("post_year", F.year("timestamp"))
    if kind == "users":
        clean = clean.withColumns({"age_group": age_group("age"), "year_joined": F.year("date_joined")})
    return clean.groupBy(KEY, *PARTS[kind]).agg(F.count(F.lit(1)).alias(COUNT))


class State:
    """The folder that the runs share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop_path = spark._jvm.org.apache.hadoop.fs.Path

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def manifests(self) -> list[dict]:
        """Those of all runs that are done, in order."""
        root = self._hadoop_path(f"{self.path}/manifest")
        fs = self._fs(root)
        if not fs.exists(root):
            return []
        names = sorted(f.getPath().toString() for f in fs.listStatus(root) if f.getPath().getName().endswith(".json"))
        if not names:
            return []
        texts = self.spark.read.text(names, wholetext=True).select("value").collect()  # one row a run
        return sorted((json.loads(r["value"]) for r in texts), key=lambda m: m["run"])

    def commit(self, manifest: dict) -> None:
        target = self._hadoop_path(f"{self.path}/manifest/{manifest['run']:012d}.json")
        tried = self._hadoop_path(f"{self.path}/manifest/_{manifest['run']:012d}.tmp")
        fs = self._fs(target)
        out = fs.create(tried, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not fs.rename(tried, target):
            raise OSError(f"run {manifest['run']} could not be entered in {self.path}")

    def listing(self, root: str, topic: str) -> dict[str, list[int]]:
        """``{file: [bytes, modification time]}`` of a topic."""
        pattern = self._hadoop_path(topic_path(root, topic))
        found = self._fs(pattern).globStatus(pattern) or []
        return {f.getPath().toString(): [f.getLen(), f.getModificationTime()] for f in found}

    def parts(self, kind: str, manifests: list[dict] | None = None) -> DataFrame:
        """The stored counts of all runs that are done and not merged away."""
        manifests = self.manifests() if manifests is None else manifests
        merged = {n for m in manifests for n in m.get("covers", [])}
        live = [f"{self.path}/{kind}/run={m['run']}" for m in manifests if m["run"] not in merged]
        if not live:
            return _counts(kind, CLEANERS[kind](self.spark.createDataFrame([], RAW[kind])))
        return self.spark.read.parquet(*live).select(KEY, *PARTS[kind], COUNT)


def update(spark: SparkSession, topics: str, state: str) -> dict[str, int]:
    """Read the files that are new under ``topics`` (posts, geo, users) and store
    their counts; the number of files read of each kind.  A file that has been
    read and has changed since is refused, because its old rows are in the counts."""
    st = State(spark, state)
    manifests = st.manifests()
    run = max((m["run"] for m in manifests), default=-1) + 1
    files: dict[str, dict[str, list[int]]] = {}
    for kind in RAW:
        done = {f: mark for m in manifests for f, mark in m.get("files", {}).get(kind, {}).items()}
        now = st.listing(topics, kind)
        if changed := sorted(f for f in now if f in done and done[f] != now[f]):
            raise ValueError(f"files changed after they were read: {changed[:3]}")
        files[kind] = {f: mark for f, mark in now.items() if f not in done}
    if not any(files.values()):
        return dict.fromkeys(RAW, 0)
    for kind, new in files.items():
        raw = spark.read.schema(RAW[kind]).json(sorted(new)) if new else spark.createDataFrame([], RAW[kind])
        _counts(kind, CLEANERS[kind](raw)).write.mode("overwrite").parquet(f"{st.path}/{kind}/run={run}")
    st.commit({"run": run, "files": files})
    return {kind: len(new) for kind, new in files.items()}


def compact(spark: SparkSession, state: str) -> int:
    """Merge the counts of all runs into one, so that questions open few files
    however often runs were scheduled; the runs merged."""
    st = State(spark, state)
    manifests = st.manifests()
    merged = {n for m in manifests for n in m.get("covers", [])}
    live = [m["run"] for m in manifests if m["run"] not in merged]
    if len(live) < 2:
        return 0
    run = max(live) + 1
    for kind in RAW:
        st.parts(kind, manifests).groupBy(KEY, *PARTS[kind]).agg(F.sum(COUNT).alias(COUNT)) \
            .write.mode("overwrite").parquet(f"{st.path}/{kind}/run={run}")
    st.commit({"run": run, "covers": live})
    return len(live)


# ---------------------------------------------------------------- answers (A1-A3, A5)

def category_counts_by_country(spark: SparkSession, state: str) -> DataFrame:
    """As :func:`postlake.plans.questions.category_counts_by_country`, unsorted."""
    st = State(spark, state)
    return joined_weights([(st.parts("geo"), ["country"], COUNT), (st.parts("posts"), ["category"], COUNT)], KEY)


def posts_per_category_year(spark: SparkSession, state: str, lo: int = 2018, hi: int = 2022) -> DataFrame:
    st = State(spark, state)
    years = st.parts("geo").where(F.col("post_year").between(lo, hi))
    return joined_weights([(years, ["post_year"], COUNT), (st.parts("posts"), ["category"], COUNT)], KEY)


def category_counts_by_age_group(spark: SparkSession, state: str) -> DataFrame:
    st = State(spark, state)
    return joined_weights([(st.parts("users"), ["age_group"], COUNT), (st.parts("posts"), ["category"], COUNT)], KEY,
                          "category_count")


def users_joined_by_year(spark: SparkSession, state: str) -> DataFrame:
    return State(spark, state).parts("users").groupBy("year_joined").agg(F.sum(COUNT).alias("number_users_joined"))
