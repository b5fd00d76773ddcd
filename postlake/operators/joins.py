"""Equi-joins on ``ind`` that answer counting and arg-max questions without
materialising the join.

The record tables are aligned by row offset, and offsets repeat, so an inner
join multiplies rows: m geo rows × n post rows for one ``ind``.  A hot key that
holds a large share of all rows would turn into a quadratic number of pairs in
one task.  The helpers here aggregate every side but one (the fact side) per
(key, needed columns) — partial aggregation collapses a hot key inside every
map task before anything is shuffled — and join those summaries with the fact
rows, multiplying the counts.  The result is exactly the ``count(*)`` over the
full join, but a key costs its fact rows times its distinct values on the
summarised sides: linear, never quadratic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_key_counts(df: DataFrame, key: str, cols: list[str], weight: str) -> DataFrame:
    """``(key, *cols, weight)``: rows per distinct ``(key, *cols)``; NULL keys dropped
    (an inner join never matches them)."""
    return (df.where(F.col(key).isNotNull())
              .groupBy(key, *cols).agg(F.count(F.lit(1)).alias(weight)))


def joined_counts(sides: list[tuple[DataFrame, list[str]]], key: str, out: str = "n") -> DataFrame:
    """``count(*)`` of ``side_1 ⋈ side_2 ⋈ … ON key`` grouped by the listed columns.

    ``sides`` is a list of ``(frame, column names)``.  Every side but the
    last is reduced to ``(key, columns…, weight)``; the last (the fact side,
    normally the largest) joins row by row.  The count of a group is the sum over joined rows of the product of the
    weights, aggregated map-side right after the join.

    With one side raw, a key costs (its rows on that side) × (its distinct
    values on the summarised sides): linear, never quadratic, and AQE's skew
    join splits the partition of a hot key across tasks.  The raw side is
    shuffled once, on ``key``; summaries are shuffled on (key, columns) and
    then on ``key``.  Only one side may stay raw.
    """
    weights = [f"_w{i}" for i in range(len(sides))]
    summaries = []
    for i, ((df, cols), w) in enumerate(zip(sides, weights)):
        if i == len(sides) - 1:
            summaries.append(df.where(F.col(key).isNotNull()).select(key, *cols))
        else:
            summaries.append(per_key_counts(df, key, cols, w))
    joined = reduce(lambda left, right: left.join(right, key, "inner"), summaries)
    product: Column = reduce(lambda a, b: a * b, [F.col(w) for w in weights[:-1]])
    names = [c for _, cols in sides for c in cols]
    return joined.groupBy(*names).agg(F.sum(product).alias(out))


def joined_weights(sides: list[tuple[DataFrame, list[str], str]], key: str, out: str = "n") -> DataFrame:
    """:func:`joined_counts` of sides that are partial counts already: ``(frame,
    column names, weight)``, where several rows of one ``(key, columns…)`` add up."""
    sums = [df.where(F.col(key).isNotNull()).groupBy(key, *cols).agg(F.sum(w).alias(f"_w{i}"))
            for i, (df, cols, w) in enumerate(sides)]
    joined = reduce(lambda left, right: left.join(right, key, "inner"), sums)
    product: Column = reduce(lambda a, b: a * b, [F.col(f"_w{i}") for i in range(len(sides))])
    return joined.groupBy(*[c for _, cols, _ in sides for c in cols]).agg(F.sum(product).alias(out))
