"""Named queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the test data in ``sf_dir`` (through the raw-record
derivation in :mod:`postlake.sources.testdata`) or the lake cleaned from it,
so its work grows with the data.  Queries that exercise a sink first write
their input with Spark under the shared scratch folder and read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions import (parse_follower_count, parse_follower_count_scaled,
                                percent_encode)
from postlake.functions.udfs import parse_follower_count_udf
from postlake.operators.clean import CLEANERS
from postlake.operators.decode import (decode, to_records, unpack_envelope, wrap_data,
                                       wrap_records)
from postlake.operators.drift import schema_drift
from postlake.operators.packing import pack_envelopes
from postlake.operators.quarantine import check_records, read_good, read_quarantine, start_routed, write_routed
from postlake.operators.skew_join import plan_cells
from postlake.plans import incremental
from postlake.plans import questions as q
from postlake.plans.lake import lake
from postlake.plans.sql import SQL_QUESTIONS, run_sql_question
from postlake.schemas import RAW
from postlake.session import scratch_path
from postlake.sinks.files import register_views, write_topic
from postlake.sources.files import lookup_value, read_csv, read_topic
from postlake.sources.testdata import damaged_posts, drifted_records
from postlake.streaming import record_log
from postlake.streaming.fanout import read_fanout, start_fanout
from postlake.streaming.streams import read_stream, start_clean_stream

Query = Callable[[SparkSession, str], DataFrame]

def _raw(spark, sf_dir, kind):
    return lake(spark, sf_dir).raw(kind)


def _gpu(spark, sf_dir):
    lk = lake(spark, sf_dir)
    return lk.geo, lk.posts, lk.users


# ---------------------------------------------------------------- cleaning

def _clean(kind) -> Query:
    return lambda spark, sf_dir: CLEANERS[kind](_raw(spark, sf_dir, kind))


def _follower(parse) -> Query:
    def run(spark, sf_dir):
        raw = _raw(spark, sf_dir, "posts")
        return raw.select(F.col("index").alias("ind"), parse("follower_count").alias("follower_count"))
    return run


def _age_bands(spark, sf_dir):
    return q.age_bands(lake(spark, sf_dir).users)


# ---------------------------------------------------------------- sources and sinks

def _scan_csv(spark, sf_dir):
    return read_csv(spark, lake(spark, sf_dir).csv("customer"), sep=",", header=True)


def _lookup_value(spark, sf_dir):
    keys = read_csv(spark, lake(spark, sf_dir).csv("customer"))
    return lookup_value(keys, "c_custkey", "7", "c_name")


def _percent_encode(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", percent_encode("text").alias("encoded"))


def _scan_json(kind) -> Query:
    def run(spark, sf_dir):
        return read_topic(spark, lake(spark, sf_dir).topic(kind), kind, schema=RAW[kind])
    return run


def _records_out(kind) -> Query:
    return lambda spark, sf_dir: to_records(_raw(spark, sf_dir, kind))


def _json_decode(kind) -> Query:
    def run(spark, sf_dir):
        payloads = to_records(_raw(spark, sf_dir, kind)).select(F.col("value").cast("binary").alias("data"))
        return decode(payloads, RAW[kind], "data")
    return run


def _envelope_records(spark, sf_dir):
    return unpack_envelope(wrap_records(_raw(spark, sf_dir, "posts")), RAW["posts"], "records")


def _envelope_packed(spark, sf_dir):
    """Users in envelopes of up to 500 records and 64 kB, unpacked again."""
    packed = pack_envelopes(_raw(spark, sf_dir, "users"), 500, 64 << 10)
    return unpack_envelope(packed, RAW["users"], "records")


def _envelope_data(spark, sf_dir):
    return unpack_envelope(wrap_data(_raw(spark, sf_dir, "geo")), RAW["geo"], "data")


def _stream(kind) -> Query:
    def run(spark, sf_dir):
        source = lake(spark, sf_dir).records(kind)  # the stream's input, written once
        base = scratch_path(spark, "streams", kind, unique=True)
        table = f"stream_{kind}_{base.rsplit('-', 1)[-1]}"
        query = start_clean_stream(spark, kind, source, table,
                                   f"{base}/checkpoint", path=f"{base}/table", source_fmt=record_log.FORMAT)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
        return spark.read.parquet(f"{base}/table")
    return run


def _stream_fanout(spark, sf_dir):
    """The three streams as one query; a few columns of each table."""
    lk = lake(spark, sf_dir)
    base = scratch_path(spark, "streams", "fanout", unique=True)
    tables = {kind: f"{base}/{kind}" for kind in RAW}
    query = start_fanout(spark, {kind: lk.records(kind) for kind in RAW}, tables, f"{base}/checkpoint")
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    shown = {"posts": ("category", F.col("follower_count")), "geo": ("country", F.year("timestamp")),
             "users": ("user_name", F.col("age"))}
    parts = [read_fanout(spark, tables[kind], f"{base}/checkpoint")
             .select(F.lit(kind).alias("kind"), "ind", F.col(label).alias("label"), number.cast("int").alias("number"))
             for kind, (label, number) in shown.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------- quarantine and drift

def _shown_quarantine(bad):
    return bad.select("record", "reason", F.array_join("bad_fields", ",").alias("bad_fields"))


def _quarantine(part) -> Query:
    """Damaged posts routed in one write; one of the two tables."""
    def run(spark, sf_dir):
        path = scratch_path(spark, "routed", unique=True)
        records = damaged_posts(_raw(spark, sf_dir, "posts"))
        write_routed(check_records(records, RAW["posts"], "value", key="index"), path)
        return (read_good(spark, path, RAW["posts"]) if part == "good"
                else _shown_quarantine(read_quarantine(spark, path, RAW["posts"])))
    return run


def _stream_quarantine(part) -> Query:
    """The same from a stream of the damaged posts."""
    def run(spark, sf_dir):
        records = read_stream(spark, lake(spark, sf_dir).damaged(), record_log.FORMAT)
        base = scratch_path(spark, "streams", "routed", unique=True)
        query = start_routed(check_records(records, RAW["posts"], "data", key="index"), f"{base}/table", f"{base}/checkpoint")
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
        return (read_good(spark, f"{base}/table", RAW["posts"]) if part == "good"
                else _shown_quarantine(read_quarantine(spark, f"{base}/table", RAW["posts"])))
    return run


def _schema_drift(spark, sf_dir):
    """Added, missing and retyped fields of the three topics."""
    parts = [schema_drift(drifted_records(kind, _raw(spark, sf_dir, kind)), RAW[kind])
             .select(F.lit(kind).alias("topic"), "field", "status", "found", "n") for kind in RAW]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------- scheduled runs

def _incremental(spark, sf_dir):
    """The topics arrive in two parts with a run after each; the counting
    questions from the stored counts."""
    base = scratch_path(spark, "incremental", unique=True)
    topics, state = f"{base}/topics", f"{base}/state"
    for part in (0, 1):
        for kind in RAW:
            raw = _raw(spark, sf_dir, kind)
            write_topic(raw.where(F.col(raw.columns[0]) % 2 == part), topics, kind, partition=part)
        incremental.update(spark, topics, state)
    incremental.compact(spark, state)
    answers = [("country", incremental.category_counts_by_country(spark, state), "country", "category", "n"),
               ("year", incremental.posts_per_category_year(spark, state), "post_year", "category", "n"),
               ("age", incremental.category_counts_by_age_group(spark, state), "age_group", "category", "category_count"),
               ("joined", incremental.users_joined_by_year(spark, state), "year_joined", None, "number_users_joined")]
    parts = [df.select(F.lit(name).alias("question"), F.col(label).cast("string").alias("label"),
                       (F.col(cat) if cat else F.lit(None)).cast("string").alias("category"), F.col(n).alias("n"))
             for name, df, label, cat, n in answers]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# ---------------------------------------------------------------- questions

def _split(fn, *kinds) -> Query:
    """A join question, its heavy keys dealt by the summaries kept with the tables."""
    def run(spark, sf_dir):
        lk = lake(spark, sf_dir)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        cells = plan_cells([lk.key_summary(kind) for kind in kinds], tasks)
        return fn(*[lk.clean(kind) for kind in kinds], cells=cells)
    return run


def _median_followers_sketch(spark, sf_dir):
    """The median questions from stored sketches, with the rank of each answer
    checked against all join rows."""
    lk = lake(spark, sf_dir)
    sketches, weights = lk.follower_sketches(), q.follower_weights(lk.users, lk.posts)
    parts = []
    for groups in (["age_group"], ["year_joined"], ["age_group", "year_joined"]):
        checked = q.median_rank_error(weights, q.sketched_median_followers(sketches, groups), groups)
        parts.append(checked.select(
            F.lit(",".join(groups)).alias("grouping"),
            *[(F.col(c) if c in groups else F.lit(None)).cast(t).alias(c) for c, t in (("age_group", "string"), ("year_joined", "int"))],
            "n_rows", F.coalesce(F.col("rank_error") <= 0.01, F.lit(True)).alias("within_1_percent")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _gp(fn, **kw) -> Query:
    def run(spark, sf_dir):
        g, p, _ = _gpu(spark, sf_dir)
        return fn(g, p, **kw)
    return run


def _up(fn, **kw) -> Query:
    def run(spark, sf_dir):
        _, p, u = _gpu(spark, sf_dir)
        return fn(u, p, **kw)
    return run


def _gpu_q(fn) -> Query:
    def run(spark, sf_dir):
        g, p, u = _gpu(spark, sf_dir)
        return fn(g, p, u)
    return run


def _u(fn, **kw) -> Query:
    def run(spark, sf_dir):
        return fn(lake(spark, sf_dir).users, **kw)
    return run


def _sql(name) -> Query:
    def run(spark, sf_dir):
        lk = lake(spark, sf_dir)
        register_views(lk.posts, lk.geo, lk.users)
        return run_sql_question(spark, name)
    return run


QUERIES: dict[str, Query] = {
    # cleaning (C1-C3, F1-F5, U1, F7)
    "clean_posts": _clean("posts"),
    "clean_geo": _clean("geo"),
    "clean_users": _clean("users"),
    "follower_count_native": _follower(parse_follower_count),
    "follower_count_scaled": _follower(parse_follower_count_scaled),
    "follower_count_udf": _follower(parse_follower_count_udf),
    "age_bands": _age_bands,
    # sources and sinks
    "scan_csv": _scan_csv,
    "lookup_value": _lookup_value,
    "percent_encode": _percent_encode,
    "scan_json_posts": _scan_json("posts"),
    "scan_json_geo": _scan_json("geo"),
    "scan_json_users": _scan_json("users"),
    "records_out_posts": _records_out("posts"),
    "records_out_geo": _records_out("geo"),
    "records_out_users": _records_out("users"),
    "envelope_records": _envelope_records,
    "envelope_data": _envelope_data,
    "envelope_packed": _envelope_packed,
    "json_decode_posts": _json_decode("posts"),
    "json_decode_geo": _json_decode("geo"),
    "json_decode_users": _json_decode("users"),
    # records that cannot be read, and records of another schema
    "quarantine_good": _quarantine("good"),
    "quarantine_bad": _quarantine("bad"),
    "schema_drift": _schema_drift,
    # scheduled runs that read each file once (S2; A1-A3, A5)
    "incremental_counts": _incremental,
    # joins (J1, J2, J4)
    "join_geo_posts": _split(q.join_geo_posts, "geo", "posts"),
    "join_three_way": _split(q.join_three_way, "geo", "posts", "users"),
    "join_users_posts": _split(q.join_users_posts, "users", "posts"),
    # questions (A1-A7, A5r-A7r, W1-W5)
    "category_counts_by_country": _gp(q.category_counts_by_country),
    "top_category_by_country": _gp(q.top_category_by_country),
    "posts_per_category_year": _gp(q.posts_per_category_year),
    "top_category_by_year": _gp(q.top_category_by_year),
    "top_user_by_country": _gpu_q(q.top_user_by_country),
    "top_country_by_followers": _gpu_q(q.top_country_by_followers),
    "category_counts_by_age_group": _up(q.category_counts_by_age_group),
    "top_category_by_age_group": _up(q.top_category_by_age_group),
    "median_followers_by_age_group": _up(q.median_followers_by_age_group),
    "users_joined_by_year": _u(q.users_joined_by_year),
    "median_followers_by_join_year": _up(q.median_followers_by_join_year),
    "median_followers_by_age_group_year": _up(q.median_followers_by_age_group_year),
    "users_joined_2015_2020": _u(q.users_joined_by_year, lo=2015, hi=2020),
    "median_followers_2015_2020": _up(q.median_followers_by_join_year, lo=2015, hi=2020),
    "median_followers_age_2015_2020": _up(q.median_followers_by_age_group_year, lo=2015, hi=2020),
    # medians from stored sketches
    "median_followers_sketch": _median_followers_sketch,
    # the SQL questions as Spark SQL text over the views
    **{f"sql_{name}": _sql(name) for name in SQL_QUESTIONS},
    # streams (T1-T3, S4, K1)
    "stream_posts": _stream("posts"),
    "stream_geo": _stream("geo"),
    "stream_users": _stream("users"),
    "stream_fanout": _stream_fanout,
    "stream_quarantine_good": _stream_quarantine("good"),
    "stream_quarantine_bad": _stream_quarantine("bad"),
}
