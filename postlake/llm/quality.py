"""Quality rules with risk-controlled thresholds.

A rule rejects a document when its statistic is beyond a cutoff.  Cutoffs are
chosen from fixed grids on the labelled documents so that, in each stratum
(language), good documents are rejected at a rate above ``risk`` with
probability ``delta`` at most, over all strata and rules together:

* per stratum and rule the grid is walked from the mildest cutoff on.  A step
  is taken while the exact binomial test rejects "this cutoff rejects good
  documents at a rate of ``risk`` / rules or more"; the walk stops at the first
  failure, so the grid costs no correction (fixed sequence testing);
* each walk runs at level ``delta`` / (strata * rules) (Bonferroni), and the
  rules of a stratum share the risk, so that any of them together keeps it;
* of the certified cutoffs that reject more labelled bad documents than good
  ones, the one that rejects most bad ones is used, the mildest of equals; if
  there is none, the rule is off in that stratum.

Statistics are one pass over the texts without a shuffle.  Labels join narrow
rows of counts, and what is learnt is one row per stratum and rule.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from postlake.llm.common import materialised, text_key, with_python_columns

SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words")
#: rule, statistic as SQL over STATS, cutoffs from mild to strict (a document above the cutoff is rejected)
RULES = (
    ("symbols", "n_symbols / n_words", (2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3)),
    ("repeats", "n_repeat_words / n_words", (0.45, 0.4, 0.35, 0.3)),
    ("dup_lines", "n_dup_lines / greatest(n_lines, 1)", (0.8, 0.7, 0.6, 0.5, 0.4, 0.3)),
    ("capitals", "n_upper_words / n_words", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4)),
)


def count_stats(text: str | None) -> tuple[int, ...]:
    """The numbers named in ``STATS``; all zero for NULL or no words."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # ASCII white space only
    n = len(words)
    if not n:
        return (0,) * len(STATS)
    blank = sum(map(text.count, " \t\n\x0b\f\r"))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if n >= 3:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
        pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        _, at, count = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
        again = np.flatnonzero(count[at] > 1)
        if len(again):
            hit = np.zeros(n, bool)
            hit[again] = hit[again + 1] = hit[again + 2] = True
            repeated = int(hit.sum())
    upper = sum(map(bytes.isupper, words))
    return (n, len(text) - blank, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines), upper)


def statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The input rows with the columns of ``STATS`` (longs)."""
    def make():
        return lambda texts: tuple(zip(*map(count_stats, texts), strict=True)) or ((),) * len(STATS)
    return with_python_columns(docs, [text_col], StructType([StructField(s, LongType()) for s in STATS]), make, keep=keep)


def base_failed() -> Column:
    """Too short, or mostly repeated: holds before any rule is learnt."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p): the smaller of the two tails summed from
    its largest term on, until the terms no longer count."""
    if k >= n:
        return 1.0
    log_p, log_q, top = math.log(p), math.log1p(-p), math.lgamma(n + 1)

    def tail(i: int, step: int) -> float:
        total = 0.0
        while 0 <= i <= n:
            term = math.exp(top - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log_p + (n - i) * log_q)
            total += term
            if term <= total * 1e-17:  # they only fall from here on
                break
            i += step
        return total
    return min(1.0, tail(k, -1)) if k <= n * p else max(0.0, 1.0 - tail(k + 1, 1))


def learn_cutoffs(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", stratum_col: str = "lang",
                  good_col: str = "quality", risk: float = 0.02, delta: float = 0.05,
                  row_col: str | None = None) -> DataFrame:
    """Certified cutoffs: (stratum, rule, cutoff, n_good, false_rejections).

    ``labels`` (id, good 0/1): rows with a NULL are left out; an id labelled
    both ways counts as bad; repeated labels count once.  Documents that fail
    the base rules take no part, as they are never judged.  ``row_col`` is a key
    of the text: a labelled document whose row is repeated counts once.
    """
    lab = labels.select(labels[id_col].alias("l_id"), labels[good_col].alias("good")) \
        .where("l_id is not null and good is not null").groupBy("l_id").agg(F.min("good").alias("good"))
    rows = stats.where(~base_failed()).join(lab, stats[id_col] == F.col("l_id"))
    if row_col is not None:
        rows = rows.dropDuplicates([id_col, row_col, stratum_col])
    # counts per stratum and label first: the grid is laid over sums, not over rows
    sums = [F.sum((F.expr(e) > c).cast("long")).alias(f"x{r}_{i}") for r, (_, e, grid) in enumerate(RULES) for i, c in enumerate(grid)]
    totals = rows.groupBy(F.col(stratum_col).alias("stratum"), (F.col("good") > 0).alias("good")) \
        .agg(F.count(F.lit(1)).alias("n"), *sums)
    cells = F.explode(F.array(*[
        F.struct(F.lit(r).alias("r"), F.lit(i).alias("step"), F.lit(float(c)).alias("cutoff"), F.col(f"x{r}_{i}").alias("out"))
        for r, (_, _, grid) in enumerate(RULES) for i, c in enumerate(grid)])).alias("cell")
    counts = totals.select("stratum", "good", "n", cells).select("stratum", "good", "n", "cell.*")
    counts = materialised(counts.groupBy("stratum", "r", "step", "cutoff").agg(
        F.coalesce(F.max(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("n_good"),
        F.coalesce(F.max(F.when(F.col("good"), F.col("out"))), F.lit(0)).alias("k_good"),
        F.coalesce(F.max(F.when(~F.col("good"), F.col("out"))), F.lit(0)).alias("k_bad")))
    strata = counts.select("stratum").distinct().count()
    level, share = delta / max(1, strata * len(RULES)), risk / len(RULES)

    @F.pandas_udf("boolean")
    def certified(k: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([binomial_tail(int(a), int(b), share) <= level for a, b in zip(k, n)], dtype=bool)

    walk = Window.partitionBy("stratum", "r").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    best = Window.partitionBy("stratum", "r").orderBy(F.desc("k_bad"), "step")
    names = F.array(*[F.lit(r[0]) for r in RULES])
    return counts.withColumn("ok", certified("k_good", "n_good")).withColumn("ok", F.min("ok").over(walk)) \
        .where("ok and k_bad > k_good").withColumn("place", F.row_number().over(best)).where("place = 1") \
        .select("stratum", F.get(names, F.col("r")).alias("rule"), "cutoff", "n_good", F.col("k_good").alias("false_rejections"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", good_col: str = "quality", risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Keep or reject each document.

    Returns one row per input row: id, stratum, the columns of ``STATS``,
    ``base_failed``, ``failed_rules`` (names, sorted; empty if base_failed) and
    ``kept``.

    Defined cases: a NULL text or one without words fails the base rules; NULL
    is a stratum of its own; without labels no rule is on and only the base
    rules decide.
    """
    src = docs.select(docs[id_col].alias("id"), text_key(docs[text_col]).alias("row"), docs[stratum_col].alias("stratum"),
                      docs[text_col].alias("text"))
    stats = materialised(statistics(src, keep=["id", "row", "stratum"]))
    cut = learn_cutoffs(stats, labels.select(labels[id_col].alias("id"), labels[good_col].alias("good")), "id", "stratum",
                        "good", risk, delta, row_col="row")
    by_stratum = cut.groupBy(F.col("stratum").alias("s")).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cut"))
    j = stats.join(by_stratum, F.col("stratum").eqNullSafe(F.col("s")), "left")
    fails = F.array_compact(F.array(*[
        F.when(F.col("n_words") > 0, F.when(F.expr(e) > F.try_element_at("cut", F.lit(name)), F.lit(name)))
        for name, e, _ in RULES]))
    failed = F.when(base_failed(), F.array().cast("array<string>")).otherwise(F.array_sort(fails))
    return j.select(F.col("id").alias(id_col), "stratum", *STATS, base_failed().alias("base_failed"),
                    failed.alias("failed_rules"), (~base_failed() & (F.size(failed) == 0)).alias("kept"))
