"""Line dedup: drop lines that many documents share.

Method: explode normalised lines, hash, count distinct documents per hash, drop
lines over the threshold, and reassemble by position.  DataFrame functions only.

Shuffles: hashes with row keys and positions go to the hash, never the lines
themselves; the texts move once, to meet their dropped positions.  A line that
a third of all documents hold is counted from partial sums; in the join back
to its occurrences it is one row against many, whose partition AQE splits (the
join has the key's length as a further condition, so both sides come straight
from an exchange).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postlake.llm.common import WHITE_SPACE, ascii_lower, text_key


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WHITE_SPACE)))


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key is long enough: id, row, pos, h1, h2, n."""
    line = docs.select("id", "row", F.posexplode("lines").alias("pos", "line"))
    key = line.select("id", "row", "pos", line_key(F.col("line")).alias("key")) \
        .where(F.length("key") >= min_chars)
    # two hashes with different seeds, 128 bits together
    return key.select("id", "row", "pos", F.xxhash64("key").alias("h1"),
                      F.xxhash64(F.lit(1), "key").alias("h2"), F.length("key").alias("n"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                min_docs: int = 3, carry: bool = False) -> DataFrame:
    """Drop, from all documents but the one with the largest id, the lines
    whose key has ``min_chars`` code points or more and is found in
    ``min_docs`` documents or more.

    Returns one row per input row: the id, ``n_lines`` (before dropping),
    ``n_dropped``, ``kept_text``, and with ``carry`` the whole input row as
    the struct ``doc``.

    Defined cases: a NULL or empty text is one empty line and stays an empty
    ``kept_text``; if all lines go, ``kept_text`` is empty.  Rows that share an
    id are one document for the counting, and a line stays in all rows of the
    largest id.  NULL ids are together one document, smaller than any other.
    A line repeated within one document counts it once.
    """
    cols = [docs[id_col].alias("id"), F.split(F.coalesce(docs[text_col], F.lit("")), "\n").alias("lines"),
            text_key(docs[text_col]).alias("row")]
    if carry:
        cols.append(F.struct("*").alias("doc"))
    base = docs.select(*cols)
    lines = _lines(base, min_chars)

    repeated = lines.groupBy("h1", "h2", "id").agg(F.max("n").alias("n")) \
        .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("last"), F.max("n").alias("n")) \
        .where(F.col("docs") >= min_docs).select("h1", "h2", "n", "last")
    dropped = lines.join(repeated, ["h1", "h2", "n"]) \
        .where(~F.col("id").eqNullSafe(F.col("last"))) \
        .groupBy(F.col("id").alias("d_id"), F.col("row").alias("d_row")) \
        .agg(F.collect_set("pos").alias("gone"))

    joined = base.join(dropped, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("row") == F.col("d_row")), "left")
    # lines were split below the join: looking one up by its position costs no further split
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"), lambda i: F.get("lines", i))
    out = [F.col("id").alias(id_col), F.size("lines").cast("long").alias("n_lines"),
           F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
           F.array_join(F.when(F.col("gone").isNull(), F.col("lines")).otherwise(kept), "\n").alias("kept_text")]
    return joined.select(*out, *(["doc"] if carry else []))
