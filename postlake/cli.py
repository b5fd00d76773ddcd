"""Command line: the batch questions over JSON topics, and the three streams.

    python -m postlake batch --topics ROOT [--out DIR] [--show N] [--input-bytes N --executors N]
    python -m postlake stream --sources ROOT --tables ROOT --checkpoints ROOT [--continuous] [--fan-out]
                              [--source-format record_log] [--start-at 2024-05-01T12:00:00+00:00]
    python -m postlake update --topics ROOT --state DIR [--compact]

``batch`` reads ``ROOT/<posts|geo|users>/partition=*/*.json`` with the
declared schemas, cleans each of the three tables once into Parquet under the
shared scratch folder, and answers every question from those: each answer is shown, or written as Parquet to ``DIR/<question>`` with ``--out``.
``stream`` starts one decode -> clean -> append stream per record type
(text files of JSON records under ``ROOT/<type>``, or a record log there), each
with its own checkpoint, or one query for all three with ``--fan-out``; by
default it processes what has arrived and stops.  ``update`` is a scheduled run:
it reads the topic files no earlier run has read and answers the counting
questions from the stored counts.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from postlake.operators.clean import CLEANERS
from postlake.plans import incremental
from postlake.plans import questions as q
from postlake.plans.lake import write_clean
from postlake.schemas import RAW
from postlake.session import ADAPTIVE_CONF, cluster_conf, scratch_path
from postlake.sources.files import read_topic
from postlake.streaming.fanout import start_fanout
from postlake.streaming.streams import append_stream, clean_stream, read_stream

TYPES = ("posts", "geo", "users")

# name -> (function, which clean tables it takes, in order)
QUESTIONS = {
    "top_category_by_country": (q.top_category_by_country, "gp"),
    "category_counts_by_country": (q.category_counts_by_country, "gp"),
    "posts_per_category_year": (q.posts_per_category_year, "gp"),
    "top_category_by_year": (q.top_category_by_year, "gp"),
    "top_user_by_country": (q.top_user_by_country, "gpu"),
    "top_country_by_followers": (q.top_country_by_followers, "gpu"),
    "top_category_by_age_group": (q.top_category_by_age_group, "up"),
    "median_followers_by_age_group": (q.median_followers_by_age_group, "up"),
    "users_joined_by_year": (q.users_joined_by_year, "u"),
    "median_followers_by_join_year": (q.median_followers_by_join_year, "up"),
    "median_followers_by_age_group_year": (q.median_followers_by_age_group_year, "up"),
}


def clean_topics(spark: SparkSession, root: str) -> dict:
    """``{"g": geo, "p": posts, "u": users}`` cleaned from the topic files: each
    topic is scanned once, and the questions read the clean Parquet tables."""
    base = scratch_path(spark, "topics_clean", unique=True)
    tables = {kind: write_clean(CLEANERS[kind](read_topic(spark, root, kind, RAW[kind])), kind, f"{base}/{kind}")
              for kind in TYPES}
    return {"g": tables["geo"], "p": tables["posts"], "u": tables["users"]}


def answer(tables: dict, name: str):
    fn, args = QUESTIONS[name]
    return fn(*[tables[a] for a in args])


def run_batch(spark: SparkSession, topics: str, out: str | None, show: int) -> list[str]:
    tables = clean_topics(spark, topics)
    done = []
    for name in QUESTIONS:
        df = answer(tables, name)
        if out:
            df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}")
        else:
            print(f"== {name}")
            df.show(show, truncate=False)
        done.append(name)
    return done


def run_streams(spark: SparkSession, sources: str, tables: str, checkpoints: str,
                continuous: bool = False, fmt: str = "parquet", source_fmt: str = "text",
                start_at: dt.datetime | None = None, fan_out: bool = False):
    """Start posts, geo and users streams, each with its own checkpoint, or
    (``fan_out``) one query with one checkpoint that writes all three tables."""
    if fan_out:
        paths = [{kind: f"{root.rstrip('/')}/{kind}" for kind in TYPES} for root in (sources, tables)]
        return [start_fanout(spark, *paths, f"{checkpoints.rstrip('/')}/fanout", source_fmt,
                             available_now=not continuous, start_at=start_at)]
    queries = []
    for kind in TYPES:
        records = read_stream(spark, f"{sources.rstrip('/')}/{kind}", source_fmt, start_at=start_at)
        queries.append(append_stream(
            clean_stream(records, kind), f"{kind}_clean", f"{checkpoints.rstrip('/')}/{kind}",
            fmt, f"{tables.rstrip('/')}/{kind}", available_now=not continuous))
    return queries


def run_update(spark: SparkSession, topics: str, state: str, merge: bool = False, show: int = 20) -> dict[str, int]:
    """One scheduled run; the number of files read of each topic."""
    read = incremental.update(spark, topics, state)
    if merge:
        incremental.compact(spark, state)
    for question in (incremental.category_counts_by_country, incremental.posts_per_category_year,
                     incremental.category_counts_by_age_group, incremental.users_joined_by_year):
        print(f"== {question.__name__}")
        question(spark, state).show(show, truncate=False)
    return read


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="postlake")
    sub = parser.add_subparsers(dest="command", required=True)
    b = sub.add_parser("batch", help="clean JSON topics and answer the questions")
    b.add_argument("--topics", required=True)
    b.add_argument("--out")
    b.add_argument("--show", type=int, default=20)
    s = sub.add_parser("stream", help="run the three cleaning streams")
    s.add_argument("--sources", required=True)
    s.add_argument("--tables", required=True)
    s.add_argument("--checkpoints", required=True)
    s.add_argument("--format", default="parquet")
    s.add_argument("--continuous", action="store_true")
    s.add_argument("--source-format", default="text", help="text, record_log, or any other stream source")
    s.add_argument("--start-at", type=dt.datetime.fromisoformat, help="skip records that arrived before this time")
    s.add_argument("--fan-out", action="store_true", help="one query and checkpoint for all three tables")
    i = sub.add_parser("update", help="read the topic files that are new and answer from the stored counts")
    i.add_argument("--topics", required=True)
    i.add_argument("--state", required=True)
    i.add_argument("--compact", action="store_true", help="merge the counts of all runs so far")
    i.add_argument("--show", type=int, default=20)
    for p in (b, s, i):
        p.add_argument("--input-bytes", type=int, help="size of the input, to size partitions for a cluster")
        p.add_argument("--executors", type=int)
    args = parser.parse_args(argv)

    conf = dict(ADAPTIVE_CONF) | {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    if args.input_bytes and args.executors:
        conf = cluster_conf(args.input_bytes, args.executors)
    spark = SparkSession.builder.appName(f"postlake-{args.command}").config(map=conf).getOrCreate()
    if args.command == "batch":
        run_batch(spark, args.topics, args.out, args.show)
    elif args.command == "update":
        run_update(spark, args.topics, args.state, args.compact, args.show)
    else:
        queries = run_streams(spark, args.sources, args.tables, args.checkpoints, args.continuous, args.format,
                              args.source_format, args.start_at, args.fan_out)
        for query in queries:
            query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
