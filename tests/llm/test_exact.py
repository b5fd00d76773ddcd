"""Exact dedup by chunk recipes."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from postlake.llm import exact_dedup
from tests.llm.helpers import SCHEMA, awkward, frame


def brute(rows):
    """(id, keep_id, size) per row, and per text the number of kept rows."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    top = {t: max(ids, key=lambda i: (i is not None, i or 0)) for t, ids in groups.items()}
    return sorted((str(i), str(top[t or ""]), len(groups[t or ""])) for i, t in rows), len(groups)


def check(df, **options):
    out = exact_dedup.dedup_exact(df, **options).collect()
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    want, n_groups = brute(rows)
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"]) for r in out) == want
    assert sum(r["kept"] for r in out) == n_groups
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])
    return out


def test_awkward_rows(spark):
    check(awkward(spark))


def test_empty_table_and_clashing_keep(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.dedup_exact(empty).count() == 0
    with pytest.raises(ValueError):
        exact_dedup.dedup_exact(frame(spark, ["a"]).withColumn("kept", F.lit(1)), keep=["kept"])


def test_groups_and_near_copies(spark):
    base = [" ".join(f"word{(i * 37 + j * j) % 211}" for j in range(300)) for i in range(5)]
    texts = []
    for i, t in enumerate(base):
        texts += [t] * (i + 1) + [t + " ", t.upper(), t[:-1], "x" + t]
    out = check(frame(spark, texts), least=16, most=64)
    assert {r["group_size"] for r in out} == {1, 2, 3, 4, 5}


def test_chunks_join_to_the_text_and_are_shared(spark):
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("etaoinshrdluä,.") for _ in range(rng.randint(1, 9))) for _ in range(9000)) + "\U0001f600\x00\n"
    df = frame(spark, [text, "inserted in front " + text, "", None])
    rows = df.select("doc_id", exact_dedup.chunks(F.col("text")).alias("c")).collect()
    chunks = {r["doc_id"]: r["c"] for r in rows}
    assert "".join(chunks[0]).encode("latin-1").decode() == text
    assert chunks[2] == chunks[3] == []
    assert all(len(c) <= exact_dedup.MOST for c in chunks[0])
    assert all(len(c) >= exact_dedup.LEAST for c in chunks[0][:-1])
    # boundaries follow the content: nearly all chunks survive the insertion
    assert len(set(chunks[0]) & set(chunks[1])) >= 0.8 * len(chunks[0])
    store = exact_dedup.chunk_store(df).collect()
    assert len({r["chunk_id"] for r in store}) == len(store) == len(set(chunks[0]) | set(chunks[1]))
    names = {r["chunk_id"]: r["chunk"] for r in store}
    for r in exact_dedup.dedup_exact(df).collect():
        assert "".join(names[c] for c in r["recipe"]) == "".join(chunks[r["doc_id"]])


def test_colliding_hashes_are_told_apart(spark):
    texts = [f"text number {i % 40} of many" for i in range(60)]
    df = frame(spark, texts)
    assert exact_dedup.verified_width(df) == 2
    assert exact_dedup.verified_width(df, bits=1) > 2
    check(df, bits=1)


def test_no_python_in_the_plan(spark):
    out = exact_dedup.dedup_exact(frame(spark, ["a b c", "a b c"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
