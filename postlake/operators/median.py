"""Exact lower median of weighted integer values, per group.

Input rows are ``(group…, value, weight)`` — a value standing for ``weight``
equal rows.  The result is the value at rank ``ceil(W / 2)`` of each group's
sorted multiset (``W`` = total weight), which is the lower median: the same
value ``percentile_approx(x, 0.5)`` returns when its summary is exact and what
SQL's ``percentile_disc(0.5)`` returns.  Weights let callers summarise a join
per (key, value) instead of emitting every joined row.

A radix select in two passes keeps every step bounded for 32-bit values:

1. histogram over the top 16 bits; a running sum per group finds the bucket
   that holds the target rank (at most 65,536 buckets per group);
2. only rows of the chosen bucket are re-aggregated by exact value (at most
   65,536 per group) and a running sum finds the value.

Both passes are hash aggregates with map-side combine; the windows only see
the small histograms, never raw rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, ShortType

_SHIFT = 16


def _null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]):
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def _pick(hist: DataFrame, group_cols: list[str], order_col: str, weight: str, need) -> DataFrame:
    """Rows of ``hist`` whose running weight (ordered by ``order_col``) first
    reaches ``need``; adds ``_before`` = weight strictly before the row."""
    running = Window.partitionBy(*group_cols).orderBy(order_col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    with_cum = hist.withColumn("_cum", F.sum(weight).over(running))
    before = F.col("_cum") - F.col(weight)
    return (with_cum.where((F.col("_cum") >= need) & (before < need))
                    .withColumn("_before", before))


def weighted_lower_median(weights: DataFrame, group_cols: list[str], value: str,
                          weight: str, out: str) -> DataFrame:
    """``(group…, out)`` for every group of ``weights``; ``out`` is NULL when a
    group has no non-NULL value (as SQL aggregates do).

    Nothing runs until an action.  Both passes and the group list read the
    weights, and the plan is written so that they share one exchange: no branch
    has a filter of its own that Spark would push below the weights'
    aggregation, so the exchanges under it are equal and the plan reuses one.
    """
    vtype = weights.schema[value].dataType
    if not isinstance(vtype, (IntegerType, ShortType, ByteType)):
        raise TypeError(f"weighted_lower_median needs an integer column of at most 32 bits, got {vtype}")
    g = list(group_cols)
    rows = weights.select(*g, F.col(value).cast("long").alias("_v"),
                          F.greatest(F.col(weight).cast("long"), F.lit(0)).alias("_w"))
    bucket = F.shiftright(F.col("_v"), _SHIFT)

    # Pass 1: bucket histogram, group totals, and the bucket holding the target
    # rank.  NULL values form a NULL bucket that only marks the group as
    # present: a group whose total is 0 has no value, and keeps a NULL median.
    hist = rows.groupBy(*g, bucket.alias("_b")).agg(F.sum("_w").alias("_bw"))
    valued = F.when(F.col("_b").isNotNull(), F.col("_bw"))
    hist = hist.withColumn("_total", F.coalesce(F.sum(valued).over(Window.partitionBy(*g)), F.lit(0)))
    empty = (hist.where(F.col("_b").isNull() & (F.col("_total") == 0))
                 .select(*g, F.lit(None).cast(vtype).alias(out)))
    target = F.shiftright(F.col("_total") + 1, 1)  # ceil(total / 2)
    ranked = hist.where(F.col("_b").isNotNull()).withColumn("_target", target)
    chosen = (_pick(ranked, g, "_b", "_bw", F.col("_target"))
              .select(*g, "_b", (F.col("_target") - F.col("_before")).alias("_need")))

    # Pass 2: exact values inside the chosen bucket only.
    inside = rows.withColumn("_b", bucket)
    cond = _null_safe_on(inside, chosen, [*g, "_b"])  # a chosen bucket is never NULL
    narrowed = inside.join(chosen, cond, "inner").select(
        *[inside[c] for c in g], inside["_v"], inside["_w"], chosen["_need"])
    exact = narrowed.groupBy(*g, "_v", "_need").agg(F.sum("_w").alias("_vw"))
    found = _pick(exact, g, "_v", "_vw", F.col("_need")).select(
        *g, F.col("_v").cast(vtype).alias(out))
    return found.unionByName(empty)

