"""Merkle manifest of a dataset: one root digest, and for each row a proof.

Method: slot pivot.  The nodes of a level are numbered inside their partition of
the data; conditional aggregates spread each parent's children into one column a
slot.  The columns concatenated and hashed are the parent; the columns but the
own one are the siblings that a child's proof needs.  The sub-roots of the
partitions are the leaves of one more tree.

At scale: leaves are numbered by a range sort, from local row numbers and the
counts before each range, so no window holds a partition of the data whole.  A
level is one aggregation, a fanout-th of the one below.  Proofs are built from
the root down and joined to parents only, so the widest rows are never shuffled
at the level of the leaves.  What comes to the driver is one number a tree (its
largest leaf count, which gives its height).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from postlake.llm.common import materialised

#: Of each level on the way up, the digests left and right of the own slot.
PATH = "array<struct<left:string,right:string>>"


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 (lowercase hex) of the values: ``-`` if NULL, else the number of
    UTF-8 bytes, a colon, and the value as a string."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[one(c) for c in columns]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_text(path: Column) -> Column:
    """All siblings from the leaf's level up, each level from left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def _numbered(df: DataFrame, part: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``seq``, ordered by ``part`` and ``order`` over all tasks,
    and per (part, task) the ``first`` seq, the rows ``before`` it in the part
    and the part's ``m`` rows."""
    by = [F.col(c).asc_nulls_first() for c in [part, *order]]
    rows = materialised(df.repartitionByRange(*by).sortWithinPartitions(*by)
                        .withColumn("seq", F.monotonically_increasing_id()))
    # the upper bits of seq are the task, the lower its rows from 0 on
    runs = rows.groupBy(part, F.shiftright("seq", 33).alias("task")) \
        .agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(part)
    return rows, runs.select(
        part, "task", "first", F.sum("n").over(w).alias("m"),
        F.coalesce(F.sum("n").over(w.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))


@dataclass
class _Tree:
    """``parents[k]``: level k + 1 with its children in slots.  ``tops``: per
    partition ``p`` the remaining node ``h`` and the ``height`` where it stands."""

    parents: list[DataFrame]
    tops: DataFrame


def _build(nodes: DataFrame, fanout: int) -> _Tree:
    """Trees over ``nodes`` (p, pos, m, h, item): position and number of nodes
    inside p, digest, and what the leaf carries."""
    tallest = nodes.agg(F.max("m")).first()[0] or 0
    parents, tops, level = [], [nodes.where("m = 1").select("p", "h", F.lit(0).alias("height"), "item")], nodes
    while tallest > 1:
        slot = F.col("pos") % fanout
        wide = [F.first(F.when(slot == k, F.col(c)), ignorenulls=True).alias(f"{c}{k}")
                for k in range(fanout) for c in (("h", "item") if not parents else ("h",))]
        pivot = level.where("m > 1").groupBy("p", F.expr(f"pos div {fanout}").alias("pos")) \
            .agg(F.expr(f"(max(m) + {fanout - 1}) div {fanout}").alias("m"), *wide)
        h = F.sha2(F.concat_ws("", *[f"h{k}" for k in range(fanout)]), 256)
        parents.append(materialised(pivot.withColumn("h", h)))
        level = parents[-1].select("p", "pos", "m", "h")
        tops.append(level.where("m = 1").select("p", "h", F.lit(len(parents)).alias("height"),
                                                F.lit(None).cast(nodes.schema["item"].dataType).alias("item")))
        tallest = -(-tallest // fanout)
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return _Tree(parents, materialised(out))


def _leaves(tree: _Tree, above: DataFrame, fanout: int) -> DataFrame:
    """Every leaf's ``item`` with its ``path`` and the other columns of
    ``above``, which has p, path (from the partition's top to the root) and
    columns to hand down."""
    down = [c for c in above.columns if c not in ("p", "path")]
    tops = tree.tops.select(F.col("p").alias("t_p"), "height", "item", F.col("h").alias("top"))
    starts = above.join(tops, F.col("p") == F.col("t_p")).select("p", "height", "item", "path", "top", *down)
    paths = None
    for k in range(len(tree.parents), 0, -1):
        here = starts.where(F.col("height") == k).select("p", F.lit(0).cast("long").alias("pos"), "path", "top", *down)
        paths = here if paths is None else paths.unionByName(here)
        parent = tree.parents[k - 1].drop("m", "h")
        both = parent.join(paths, ["p", "pos"])
        hs = [F.col(f"h{s}") for s in range(fanout)]
        children = F.array(*[F.struct(
            hs[s].isNotNull().alias("there"), (F.col("pos") * fanout + s).alias("pos"),
            (F.col(f"item{s}") if k == 1 else F.lit(None).cast("int")).alias("item"),
            F.concat(F.array(F.struct(F.concat_ws("", *hs[:s]).alias("left"), F.concat_ws("", *hs[s + 1:]).alias("right"))),
                     F.col("path")).alias("path")) for s in range(fanout)])
        paths = both.select("p", "top", *down, F.explode(F.filter(children, lambda c: c["there"])).alias("c")) \
            .select("p", F.col("c.pos").alias("pos"), F.col("c.item").alias("item"), F.col("c.path").alias("path"), "top", *down)
        if k > 1:
            paths = paths.drop("item")
    lone = starts.where("height = 0").select("item", "path", "top", *down)
    return lone if paths is None else paths.select("item", "path", "top", *down).unionByName(lone)


def manifest(docs: DataFrame, id_col: str = "doc_id", part_col: str = "source",
             fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), fanout: int = 3,
             keep: list[str] | None = None) -> DataFrame:
    """Digests of all rows and of the whole table.

    In each value of ``part_col`` the leaves stand by id; ``fanout`` neighbours
    make a parent until one node, the sub-root, remains.  The sub-roots, by the
    value (NULL first, then bytewise), make the root the same way.

    Returns one row per input row: the id, ``leaf``, ``subroot``, ``root``,
    ``path`` (per level the siblings left and right; :func:`fold` and
    :func:`proof_text` read it) and the input columns in ``keep``.

    Defined cases: NULL values have a mark of their own, so NULL and ``-`` differ.
    NULL ids stand first.  Rows of one id stand by their leaf digest, so the
    root does not depend on the order of the input; rows that are equal in all
    fields are leaves of their own.  A lone row is its own sub-root, with no
    sibling there; a table of one row has an empty path and is its own root.
    An empty table gives an empty result and no root.  Other columns are
    ignored; a column in ``keep`` must not have the name of a result column
    (refused).
    """
    own = [id_col, "leaf", "subroot", "root", "path"]
    if clash := set(keep or []) & set(own):
        raise ValueError(f"columns {sorted(clash)} are results; rename them first")
    item = F.struct(docs[id_col].alias("id"), leaf_digest([docs[c] for c in fields]).alias("leaf"),
                    F.struct(*[docs[c] for c in keep or []], F.lit(0).alias("none")).alias("keep"))
    base = materialised(docs.select(docs[part_col].alias("part"), item.alias("item"),
                                    F.monotonically_increasing_id().alias("row")))
    rows, runs = _numbered(base, "part", ["item.id", "item.leaf", "row"])
    runs = materialised(runs)

    # partitions of the data by number, NULL first
    named = runs.select("part").distinct().withColumn("all", F.lit(0))
    part_rows, part_runs = _numbered(named, "all", ["part"])
    numbers = part_rows.join(part_runs, (part_rows["all"] == part_runs["all"])
                             & (F.shiftright("seq", 33) == F.col("task"))) \
        .select(F.col("part").alias("n_part"), (F.col("seq") - F.col("first") + F.col("before")).alias("p"),
                F.col("m").alias("parts"))
    numbers = materialised(numbers)
    runs = runs.join(numbers, F.col("part").eqNullSafe(F.col("n_part"))) \
        .select(F.col("part").alias("r_part"), "task", "first", "before", "m", "p")
    leaves = rows.join(runs, F.col("part").eqNullSafe(F.col("r_part")) & (F.shiftright("seq", 33) == F.col("task"))) \
        .select("p", (F.col("seq") - F.col("first") + F.col("before")).alias("pos"), "m", F.col("item.leaf").alias("h"), "item")

    tree = _build(leaves, fanout)
    subroots = tree.tops.select("p", F.col("h").alias("subroot")).join(numbers.select("p", "parts"), "p") \
        .select(F.lit(0).cast("long").alias("p"), F.col("p").alias("pos"), F.col("parts").alias("m"),
                F.col("subroot").alias("h"), F.col("p").alias("item"))
    crown = _build(subroots, fanout)
    start = crown.tops.select("p", F.array().cast(PATH).alias("path"))
    tops = _leaves(crown, start, fanout).select(F.col("item").alias("p"), F.col("top").alias("root"), "path")
    out = _leaves(tree, materialised(tops), fanout)
    return out.select(F.col("item.id").alias(id_col), F.col("item.leaf").alias("leaf"), F.col("top").alias("subroot"),
                      "root", "path", *[F.col("item.keep")[c].alias(c) for c in keep or []])
