"""Top-n rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group_cols: list, order: list[Column], n: int = 1,
                    rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows of every group under ``order``.

    ``order`` must end in tie-breakers that make it total, otherwise which
    tied row survives depends on row order.  Written as ``row_number`` plus a
    filter, which Spark plans as a partial ``WindowGroupLimit`` before the
    shuffle and a final one after it: every map task forwards at most ``n``
    rows per group, so a group holding a third of all rows never lands whole
    in one task.
    """
    rn = rank_col or "_rn"
    ranked = df.withColumn(rn, F.row_number().over(Window.partitionBy(*group_cols).orderBy(*order)))
    kept = ranked.where(F.col(rn) <= n)
    return kept if rank_col else kept.drop(rn)
