"""Mixing sources to target weights by entropy balancing.

Each document gets a rate: the copies the mix takes of it.  Among all rates
between 0 and ``max_copies`` whose words meet the targets of the sources, the
ones nearest to one copy each (in relative entropy) are exponentially tilted:
``min(max_copies, exp(lambda * size / mean size))``, with one dual variable
``lambda`` a source.  Its convex dual is solved by Newton steps, each one
distributed aggregation over the (source, size) histogram, kept inside a
shrinking bracket.  The rates are then rounded into copies.

The documents themselves are touched three times: to count words, to build
the histogram, and to hand out the copies.  The histogram has a row for each
distinct size of a source, however many documents share it.  Sums are exact
(decimals), and the choice among equal documents goes by a hash of the id, so
reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from postlake.llm.common import materialised, text_key

_EXACT = "decimal(38,9)"
BUCKETS = 1024  # hash buckets in which the documents of one (source, size) are ranked


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; NULL text: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds ``rank``: the place of ``source`` in code point order, NULL last.

    A range-partitioned sort; places inside a partition and the partitions'
    row counts (one row a partition) give the global place.
    """
    placed = materialised(sources.orderBy(F.col("source").asc_nulls_last())
                          .withColumn("mono", F.monotonically_increasing_id()))
    placed = placed.select("*", F.shiftrightunsigned("mono", 33).alias("part"),
                           F.col("mono").bitwiseAND(F.lit((1 << 33) - 1)).alias("inside")).drop("mono")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")) \
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return placed.join(offset, "part").withColumn("rank", F.col("inside") + F.col("offset")) \
        .drop("part", "inside", "offset")


def targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
            max_copies: float = 2.0) -> DataFrame:
    """``sizes`` (source, source_size) with a ``target`` for each source.

    The sources in code point order, NULL last, take the ``weights`` in turn
    and share ``share`` times all sizes; a target stops at ``max_copies`` times
    its source's size, and the excess is shared again by weight among the
    others until none is above.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    t = _ranked(sizes).withColumn("weight", F.get(cycle, F.pmod("rank", F.lit(len(weights))).cast("int"))) \
        .withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
    t = materialised(t)
    total = float(t.agg(F.sum("source_size")).first()[0] or 0) * share
    level, stopped = 0.0, -1
    while True:  # a round stops at least one more source, or is the last
        above = F.col("weight") * level >= F.col("cap")
        taken, weight, n = t.agg(F.sum(F.when(above, F.col("cap")).otherwise(0.0)),
                                 F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
                                 F.sum(above.cast("long"))).first()
        if n is None or n == stopped or not weight:
            break
        stopped, level = n, (total - taken) / weight
    return t.withColumn("target", F.least(F.col("weight") * level, F.col("cap")) if level else F.lit(0.0)) \
        .select("source", "source_size", "target")


def _rate(x: Column, lam: Column, max_copies: float) -> Column:
    return F.exp(F.least(lam * x, F.lit(math.log(max_copies))))


def solve_dual(hist: DataFrame, goal: DataFrame, max_copies: float = 2.0, tolerance: float = 1e-7,
               max_steps: int = 80) -> DataFrame:
    """``lambda`` for each source: sum of n * size * rate(size) = target.

    ``hist``: (source, size > 0, n).  ``goal``: (source, target).  Newton on
    the logarithm of the sum, which is nearly linear; a step that leaves the
    bracket is replaced by its middle.
    """
    cap = math.log(max_copies)
    moments = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("docs"),
                                         F.min("size").alias("least"))
    g = goal.select(F.col("source").alias("g"), "target")
    s = moments.join(g, F.col("source").eqNullSafe(F.col("g"))).drop("g")
    low_x = F.col("least") * F.col("docs") / F.col("words")
    ratio = F.log(F.greatest(F.col("target") / F.col("words"), F.lit(1e-12)))
    s = s.select("source", "target", (F.col("words") / F.col("docs")).alias("mean"),
                 F.least(ratio / low_x, F.lit(0.0)).alias("lo"),
                 F.when(ratio > 0, cap / low_x).otherwise(0.0).alias("hi"),
                 F.when(F.col("target") >= F.col("words") * max_copies * (1 - 1e-12), cap / low_x)
                 .otherwise(F.least(ratio, F.lit(cap))).alias("lam"),
                 (F.col("target") >= F.col("words") * max_copies * (1 - 1e-12)).alias("done"))
    s = materialised(s)
    h = hist.select(F.col("source").alias("h"), "size", "n")
    for _ in range(max_steps):
        if not s.where("not done").limit(1).count():
            break
        x = F.col("size") / F.col("mean")
        w = F.col("n") * F.col("size") * _rate(x, F.col("lam"), max_copies)
        slope = F.when(F.col("lam") * x < cap, w * x).otherwise(0.0)
        sums = s.where("not done").join(h, F.col("source").eqNullSafe(F.col("h"))) \
            .groupBy(F.col("source").alias("k")) \
            .agg(F.sum(w.cast(_EXACT)).cast("double").alias("sum"), F.sum(slope.cast(_EXACT)).cast("double").alias("slope"))
        j = s.join(sums, F.col("source").eqNullSafe(F.col("k")), "left")
        near = F.col("done") | (F.abs(F.col("sum") / F.col("target") - 1) <= tolerance)
        lo = F.when(F.col("sum") < F.col("target"), F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(F.col("sum") > F.col("target"), F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - F.log(F.col("sum") / F.col("target")) * F.col("sum") / F.nullif(F.col("slope"), F.lit(0.0))
        inside = (step > lo) & (step < hi)
        nxt = F.when(near, F.col("lam")).when(inside, step).otherwise((lo + hi) / 2)
        s = materialised(j.select("source", "target", "mean", F.when(near, F.col("lo")).otherwise(lo).alias("lo"),
                                  F.when(near, F.col("hi")).otherwise(hi).alias("hi"), nxt.alias("lam"),
                                  F.coalesce(near, F.lit(True)).alias("done")))
    return s.select("source", "target", "mean", F.col("lam").alias("lambda"))


def _round_source(cells: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for each size of one source, the large sizes first, each
    making up for what rounding the ones before has left over or short."""
    cells = cells.sort_values("size", ascending=False)
    taken, wanted, out = 0, 0.0, []
    for size, n, rate, most in zip(cells["size"], cells["n"], cells["rate"], cells["most"]):
        wanted += float(rate) * int(n) * int(size)
        k = min(max(round((wanted - taken) / int(size)), 0), int(n) * int(most))
        taken += k * int(size)
        out.append(k)
    return cells.assign(copies=out)[["source", "size", "n", "rate", "copies"]]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_copies: int = 2) -> DataFrame:
    """Copies of each document so that each source's words meet its target.

    Returns one row per input row: id, ``row`` (key of the text), ``size``
    (words), ``source_size``, ``target`` (words the mix wants of its source),
    ``rate`` (the entropy-balanced rate), ``copies`` (0 to ``max_copies``) and
    ``taken`` (size * copies).  A source's taken words miss its target by
    about half its smallest document at most, unless all its documents are at
    a limit.

    Defined cases: a text without words, or NULL, has size 0, rate 1 and one
    copy, which takes nothing; NULL is a source of its own; NULL ids and
    repeated rows are documents like others; a source without words has
    target 0.  A source's distinct sizes meet in one task when copies are
    rounded: at most as many as its longest document has words.
    """
    sized = materialised(docs.select(docs[id_col].alias("id"), text_key(docs[text_col]).alias("row"),
                                     docs[source_col].alias("source"), word_count(docs[text_col]).alias("size")))
    hist = materialised(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sizes = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = materialised(targets(sizes, weights, share, max_copies))
    dual = solve_dual(hist.where("size > 0"), goal.select("source", "target"), max_copies)

    d = dual.select(F.col("source").alias("k"), "mean", F.col("lambda"))
    cells = hist.where("size > 0").join(d, F.col("source").eqNullSafe(F.col("k"))).drop("k") \
        .select("source", "size", "n", F.lit(max_copies).alias("most"),
                _rate(F.col("size") / F.col("mean"), F.col("lambda"), max_copies).alias("rate"))
    rounded = cells.groupBy("source").applyInPandas(
        _round_source, "source string, size long, n long, rate double, copies long")
    g = goal.select(F.col("source").alias("g"), "source_size", "target")
    plan = hist.where("size = 0").select("source", "size", "n", F.lit(1.0).alias("rate"), F.col("n").alias("copies")) \
        .unionByName(rounded).join(g, F.col("source").eqNullSafe(F.col("g")))
    plan = materialised(plan.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), "source_size", "target",
                                    "rate", F.expr("copies div n").alias("each"), F.expr("copies % n").alias("extra")))

    # each document gets `each`; the `extra` of its (source, size) with the smallest hashes get one more
    dealt = sized.withColumn("h", F.xxhash64(F.lit("mix"), "id", "row")) \
        .withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 40), F.lit(BUCKETS)).cast("int")) \
        .join(plan, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")))
    cell = ["p_source", "p_size"]
    counts = dealt.where("extra > 0").groupBy(*cell, "bucket").agg(F.count(F.lit(1)).alias("c"), F.max("extra").alias("x"))
    before = Window.partitionBy(*cell).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    need = counts.select(*[F.col(c).alias("n_" + c) for c in (*cell, "bucket")],
                         (F.col("x") - F.coalesce(F.sum("c").over(before), F.lit(0))).alias("need")).where("need > 0")
    place = F.row_number().over(Window.partitionBy(*cell, "bucket").orderBy("h", "id", "row"))
    ranked = dealt.where("extra > 0").withColumn("place", place)
    same = F.col("p_source").eqNullSafe(F.col("n_p_source")) & (F.col("p_size") == F.col("n_p_size")) \
        & (F.col("bucket") == F.col("n_bucket"))
    partly = ranked.join(need, same, "left") \
        .withColumn("copies", F.col("each") + (F.col("place") <= F.coalesce("need", F.lit(0))).cast("long"))
    whole = dealt.where("extra = 0").withColumn("copies", F.col("each"))
    cols = [F.col("id").alias(id_col), "row", "size", "source_size", "target", "rate", "copies",
            (F.col("size") * F.col("copies")).alias("taken")]
    return whole.select(*cols).unionByName(partly.select(*cols))
