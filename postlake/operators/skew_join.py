"""Inner join of tables in which a few keys hold most of the rows.

A plain shuffle join sends all rows of a key to one task.  Here the rows of a
heavy key are dealt over a grid: side i cuts them into ``p_i`` parts, and a row
is copied to every cell that holds its part, so each pair (triple, …) of rows
meets in exactly one cell.  Light keys have one cell and are joined plainly, in
the same join.  The grid's cells are join keys, so a chain of joins on one key
needs one shuffle a side however many sides there are.

Which keys are heavy comes from mergeable summaries of each side's keys (Spark's
frequent-items sketch, a partial aggregate): they can be kept beside a table,
one for each of its parts, and merged when a query runs.  The summaries only
decide how rows are dealt: whatever they hold, the result is the join.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that a summary tracks: a key with more than a 1/TRACKED share of a
#: side's rows or so is surely in it.  Bounds what is merged and broadcast.
TRACKED = 4096


def key_summary(df: DataFrame, key: str, by: list[str] | None = None, tracked: int = TRACKED) -> DataFrame:
    """``(summary, n)``: the frequent-items sketch of ``key`` and the number of
    rows with a key, for the whole table or for each value of ``by``."""
    return df.where(F.col(key).isNotNull()).groupBy(*(by or [])).agg(
        F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("summary"), F.count(F.lit(1)).alias("n"))


def merge_summaries(summaries: DataFrame, tracked: int = TRACKED) -> tuple[dict, int]:
    """Estimated rows of the heaviest keys (``tracked`` at most) and the number
    of rows, from the rows of :func:`key_summary`."""
    parts = summaries.where("n > 0")
    # one group rather than none: tasks without rows then send nothing, which the sketch could not write
    row = parts.groupBy(F.lit(1)).agg(
        F.sum("n").alias("n"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(summary, {tracked}), {tracked})").alias("top")).first()
    if row is None:
        return {}, 0
    return {r["item"]: r["count"] for r in row["top"]}, row["n"]


def plan_cells(sides: list[tuple[dict, int]], tasks: int, per_task: int = 8) -> dict:
    """``{key: (p_1, …, p_d)}`` for the keys whose load (rows read and rows
    joined) is more than a ``per_task``-th of a task's share.

    A heavy key gets cells in proportion to its load.  A side's parts are in
    proportion to its rows, which keeps the copies fewest; no side is cut into
    more parts than it has rows.
    """
    keys = set().union(*[set(top) for top, _ in sides])
    counts = {k: [max(top.get(k, 0), 1) for top, _ in sides] for k in keys}
    load = {k: sum(c) + math.prod(c) for k, c in counts.items()}
    unit = (sum(n for _, n in sides) + sum(load.values())) / (tasks * per_task)
    cells: dict = {}
    for k, c in counts.items():
        wanted = math.ceil(load[k] / unit) if unit else 1
        if wanted < 2:
            continue
        # p_i = c_i * (wanted / product of c) ** (1 / d); sides of few rows stay whole, the others share what is left
        parts, free = [1] * len(c), sorted(range(len(c)), key=lambda i: c[i])
        while free:
            scale = (wanted / math.prod(c[i] for i in free)) ** (1 / len(free))
            if c[free[0]] * scale >= 1:
                for i in free:
                    parts[i] = min(c[i], math.ceil(c[i] * scale))
                break
            free.pop(0)
        if math.prod(parts) > 1:
            cells[k] = tuple(parts)
    return cells


def split_join(sides: list[DataFrame], key: str, cells: dict) -> DataFrame:
    """The inner join of ``sides`` on ``key``, the keys of ``cells`` dealt over
    their grids.  The sides' other columns must have different names.

    Rows are dealt by their place in their task, so the sides should be scans or
    checkpoints, whose tasks give the same rows in the same order if repeated.
    """
    names = [c for df in sides for c in df.columns if c != key]
    if len(set(names)) < len(names):
        raise ValueError("the sides share column names besides the key")
    axes = [f"__axis{i}" for i in range(len(sides))]
    if not cells:
        return reduce(lambda a, b: a.join(b, key, "inner"), sides)
    spark = sides[0].sparkSession
    kind = sides[0].schema[key].dataType.simpleString()
    plan = F.broadcast(spark.createDataFrame([(k, list(p)) for k, p in cells.items()], f"__key {kind}, __parts array<int>"))

    def dealt(i: int) -> DataFrame:
        df = sides[i].where(F.col(key).isNotNull())
        out = df.join(plan, df[key] == plan["__key"], "left").withColumn("__place", F.monotonically_increasing_id())
        for j, axis in enumerate(axes):
            parts = F.get("__parts", F.lit(j))
            if j == i:
                at = F.coalesce(F.pmod(F.col("__place"), parts.cast("long")).cast("int"), F.lit(0))
            else:
                at = F.explode(F.coalesce(F.sequence(F.lit(0), parts - 1), F.array(F.lit(0))))
            out = out.select("*", at.alias(axis))
        return out.drop("__key", "__parts", "__place")

    joined = reduce(lambda a, b: a.join(b, [key, *axes], "inner"), [dealt(i) for i in range(len(sides))])
    return joined.select(key, *names)
