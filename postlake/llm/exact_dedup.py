"""Exact dedup through content-defined chunk recipes.

Method: every text is cut into chunks at places that its own bytes choose, so
that equal stretches of long documents give equal chunks wherever they stand.
The chunks are deduplicated to verified identifiers, and two texts are equal if
and only if their recipes, the ordered lists of identifiers, are equal.
DataFrame functions only.

An identifier is a row of 64-bit hashes of the chunk.  Hashes alone are no
proof, so the distinct chunks themselves are compared: if two different ones
share an identifier, all identifiers get one more hash and are verified again.
With two hashes to start with that is a matter of principle, but the result is
exact.

What moves: each chunk once from every task that holds it, copies inside a
task never; after that recipes only, some 20 bytes a chunk.  A long document is
never moved whole.  A group of copies that holds a third of all rows is counted
from partial sums, and in the join back it is one row against many, whose
partition AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postlake.llm.common import materialised

#: Chunk sizes in bytes: at least (but for the last of a text), at most.
LEAST, MOST = 512, 4096


def _byte_class(factor: int) -> str:
    """A quarter of all bytes as a class of a regular expression, dealt by a
    multiplicative hash so that every alphabet has bytes in it."""
    return "[" + "".join(f"\\x{b:02x}" for b in range(256) if b * factor % 251 % 4 == 0) + "]"


def cut_pattern(least: int = LEAST, most: int = MOST) -> str:
    """Matches one chunk after the other: as many bytes as are needed beyond
    ``least`` to end in one of the four-byte contexts that mark a cut (some
    hundreds of bytes apart), or else ``most`` bytes, or the rest."""
    marks = ("".join(_byte_class(f) for f in fs) for fs in ((167, 91, 213, 59), (73, 199, 37, 149)))
    return f"(?s).{{{least - 4},{most - 4}}}?(?:{'|'.join(marks)})|.{{1,{most}}}"


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The chunks of a text, in order, one character a byte (ISO-8859-1 of the
    UTF-8 bytes).  NULL and empty texts have none."""
    one_a_byte = F.decode(F.coalesce(text, F.lit("")).cast("binary"), "ISO-8859-1")
    return F.regexp_extract_all(one_a_byte, F.lit(cut_pattern(least, most)), F.lit(0))


def _identifier(chunk: Column, width: int, bits: int) -> Column:
    """``width`` hashes with different seeds; ``bits`` of the first two count."""
    def seeded(seed: int) -> Column:
        h = F.xxhash64(F.lit(seed), chunk)
        return h if bits >= 64 or seed > 1 else h.bitwiseAND(F.lit((1 << bits) - 1))
    return F.struct(*[seeded(k).alias(f"h{k}") for k in range(width)])


def chunk_store(docs: DataFrame, text_col: str = "text", least: int = LEAST, most: int = MOST,
                width: int = 2, bits: int = 64) -> DataFrame:
    """The distinct chunks of all texts: ``chunk_id`` and ``chunk`` (see
    :func:`chunks`).  Copies within a task are dropped before the shuffle."""
    each = docs.select(F.explode(chunks(docs[text_col], least, most)).alias("chunk"))
    return each.select(_identifier(F.col("chunk"), width, bits).alias("chunk_id"), "chunk").distinct()


def verified_width(docs: DataFrame, text_col: str = "text", least: int = LEAST, most: int = MOST,
                   bits: int = 64) -> int:
    """The number of hashes that tells all distinct chunks of ``docs`` apart,
    found by comparing the chunks themselves.  ``bits`` < 64 weakens the first
    two hashes (for tests of the verification)."""
    for width in range(2, 9):
        shared = chunk_store(docs, text_col, least, most, width, bits) \
            .groupBy("chunk_id").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
        if shared.agg(F.count(F.lit(1))).first()[0] == 0:
            return width
    raise RuntimeError("different chunks agree in eight hashes")


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
                least: int = LEAST, most: int = MOST, bits: int = 64) -> DataFrame:
    """Find the rows whose texts are equal, byte for byte.

    Returns one row per input row: the id, ``keep_id`` (the largest id of the
    group, whose row stays), ``group_size``, ``kept``, ``recipe`` (the ordered
    chunk identifiers) and the input columns in ``keep``.

    Defined cases: a NULL text counts as empty.  A row with a text of its own
    is a group of one.  A NULL id is smaller than any other.  Of rows that share
    both the largest id and the text exactly one is kept.  An empty table gives
    an empty result.  Other columns are ignored; a column in ``keep`` must not
    have the name of a result column (refused).
    """
    own = [id_col, "keep_id", "group_size", "kept", "recipe"]
    if clash := set(keep or []) & set(own):
        raise ValueError(f"columns {sorted(clash)} are results; rename them first")
    width = verified_width(docs, text_col, least, most, bits)
    recipe = F.transform(chunks(docs[text_col], least, most), lambda c: _identifier(c, width, bits))
    base = materialised(docs.select(
        docs[id_col].alias("id"), F.monotonically_increasing_id().alias("row"), recipe.alias("recipe"),
        F.lit(1).alias("one"), F.struct(*[docs[c] for c in keep or []]).alias("kept_columns") if keep else
        F.lit(None).cast("int").alias("kept_columns")))
    # the digest only deals the rows out; the lists themselves are compared
    base = base.withColumn("digest", F.xxhash64("recipe"))
    groups = base.groupBy("digest", "recipe").agg(
        F.count(F.lit(1)).alias("size"), F.max(F.struct("id", "row")).alias("top"), F.max("one").alias("one")) \
        .where("size > 1")
    # ``one`` is a key so that both sides come straight from an exchange and AQE can split a hot group
    out = base.join(groups, ["digest", "recipe", "one"], "left")
    alone = F.col("size").isNull()
    return out.select(
        F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("top.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("top.row"))).alias("kept"), "recipe",
        *[F.col("kept_columns")[c].alias(c) for c in keep or []])
