"""The Merkle manifest against a tree built in plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from postlake.llm import manifest
from tests.llm.helpers import SCHEMA, awkward, frame

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    def one(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(*[one(row[c]) for c in FIELDS])


def climb(nodes, fanout):
    """The top, and for each node its siblings (left, right) level by level."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        ups, up_owners = [], []
        for a in range(0, len(nodes), fanout):
            run = nodes[a:a + fanout]
            for k in range(len(run)):
                for i in owners[a + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            ups.append(H(*run))
            up_owners.append([i for o in owners[a:a + fanout] for i in o])
        nodes, owners = ups, up_owners
    return nodes[0], paths


def brute(rows, fanout=3):
    """Rows (id, leaf, subroot, root, path), sorted."""
    parts = {}
    for r in rows:
        parts.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r["doc_id"]))
    names = sorted(parts, key=lambda s: (s is not None, (s or "").encode()))
    trees = [climb([x[2] for x in sorted(parts[s], key=lambda x: x[:3])], fanout) for s in names]
    root, upper = climb([t[0] for t in trees], fanout)
    out = []
    for s, (sub, paths), up in zip(names, trees, upper):
        for x, p in zip(sorted(parts[s], key=lambda x: x[:3]), paths):
            out.append((str(x[3]), x[2], sub, root, tuple(p + up)))
    return sorted(out)


def check(df, fanout=3):
    got = manifest.manifest(df, fanout=fanout).withColumn("folded", manifest.fold(F.col("leaf"), F.col("path"))).collect()
    assert sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"],
                   tuple((p["left"], p["right"]) for p in r["path"])) for r in got) == brute(df.collect(), fanout)
    assert all(r["folded"] == r["root"] for r in got)


def test_awkward_rows(spark):
    check(awkward(spark))


@pytest.mark.parametrize("n, fanout", [(1, 3), (2, 2), (3, 3), (4, 3), (28, 3), (100, 5)])
def test_shapes(spark, n, fanout):
    check(frame(spark, [f"text {i}" for i in range(n)], source=[None if i % 7 == 3 else f"s{i % 4 * (i % 3)}" for i in range(n)]), fanout)


def test_many_equal_rows_and_many_tasks(spark):
    rows = [(i % 5, "same", "en", "hot", 4) for i in range(300)] + [(i, f"t{i}", "en", f"s{i}", 2) for i in range(40)]
    check(spark.createDataFrame(rows, SCHEMA).repartition(7))


def test_empty_table_and_refused_names(spark):
    assert manifest.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        manifest.manifest(frame(spark, ["a"]).withColumn("path", F.lit(1)), keep=["path"])


def test_a_changed_value_is_noticed(spark):
    df = frame(spark, [f"text\n{i}" for i in range(30)])
    changed = manifest.leaf_digest([F.when(F.col("doc_id") == 7, F.lit("other")).otherwise(F.col("text")) if c == "text"
                                    else F.col(c) for c in FIELDS])
    out = manifest.manifest(df.withColumn("now", changed), keep=["now"])
    bad = out.where(manifest.fold(F.col("now"), F.col("path")) != F.col("root")).collect()
    assert [r["doc_id"] for r in bad] == [7]
