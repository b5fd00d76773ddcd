"""SimHash near-dedup by a segment-popcount embedding.

Fingerprints are mapped to the bit counts of their segments, a vector whose
Manhattan distance never exceeds the Hamming distance, packed into 64 bits.  The
vectors are range-joined on a grid: each visits the cells within half of
``max_bits``, and two vectors within ``max_bits`` meet in a cell between them.
Vectors that meet no other, and stand for one fingerprint, are done.  Only the
fingerprints of the others are verified exactly: each visits the very 64-bit
values within half of ``max_bits`` flipped bits, and fingerprints that visit the
same value differ in at most ``max_bits`` bits.

Nothing here is quadratic.  Copies collapse to one row per fingerprint first, and
fingerprints to one row per vector; a vector visits about 50 cells for two bits
and 32 segments, and at most 65 distinct vectors can visit a cell.  A value has
at most 65 distinct visitors, which are linked to one of them, not pairwise.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from postlake.llm.common import materialised, text_key, with_python_columns
from postlake.llm.components import components

SEED = 42
CHUNK = 1 << 15  # shingles hashed at a time: bounds the memory for a very long text


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash, as a signed integer, over word shingles with repeats.
    Fewer words than ``shingle``: the whole sequence is one; none: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = np.concatenate(([0], ends + 1))
    ends = np.append(ends, len(line))
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n], ends[-n:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        h = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[i:i + CHUNK].tolist(), ends[i:i + CHUNK].tolist())),
                        np.uint64)
        # column sums of the bit matrix; float32 is exact up to 2^24 ones
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += (np.ones(len(h), np.float32) @ bits.astype(np.float32)).astype(np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, row, fp) per input row; no shuffle."""
    src = docs.select(docs[id_col].alias("id"), text_key(docs[text_col]).alias("row"), docs[text_col].alias("text"))

    def make():
        return lambda texts: ([fingerprint(t, shingle) for t in texts],)
    return with_python_columns(src, ["text"], StructType([StructField("fp", LongType())]), make, keep=["id", "row"])


def _masks(radius: int) -> list[tuple[int, int]]:
    """(mask, bits) of all 64-bit values with up to ``radius`` bits set, signed."""
    out = []
    for r in range(radius + 1):
        for bits in combinations(range(64), r):
            m = sum(1 << b for b in bits)
            out.append((m - (1 << 64) if m >> 63 else m, r))
    return out


def cell(value: Column, segments: int) -> Column:
    """The vector of bit counts of the value's segments, packed in 64 bits."""
    odd, pair, nibble = 0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F
    lo, hi = value.bitwiseAND(F.lit(odd)), F.shiftrightunsigned(value, 1).bitwiseAND(F.lit(odd))
    c = lo.bitwiseXOR(hi).bitwiseOR(F.shiftleft(lo.bitwiseAND(hi), 1))  # lo + hi in each two bits, without a sign
    if segments <= 16:
        c = c.bitwiseAND(F.lit(pair)) + F.shiftrightunsigned(c, 2).bitwiseAND(F.lit(pair))
    if segments <= 8:
        c = c.bitwiseAND(F.lit(nibble)) + F.shiftrightunsigned(c, 4).bitwiseAND(F.lit(nibble))
    return c


def _one_step(vector: Column, segments: int) -> Column:
    """The vector and those at Manhattan distance 1: one segment's count one up
    or one down, where that is still a count."""
    width = most = 64 // segments
    mask = (1 << width) - 1 if width < 64 else -1
    out = [vector]
    for k in range(segments):
        count = F.shiftrightunsigned(vector, width * k).bitwiseAND(F.lit(mask))
        for step, possible in ((1, count < most), (-1, count > 0)):
            # the field is changed by its differing bits: a sum could run into the sign
            changed = F.shiftleft(count.bitwiseXOR(count + step), width * k)
            out.append(F.when(possible, vector.bitwiseXOR(changed)))
    return F.array_compact(F.array(*out))


def in_company(fps: DataFrame, max_bits: int = 2, segments: int = 32) -> DataFrame:
    """The fingerprints (distinct, column fp) that have another one whose vector
    is within Manhattan distance ``max_bits``, or a little more for odd values:
    a superset of those with another one within ``max_bits`` bits."""
    placed = fps.select("fp", cell(F.col("fp"), segments).alias("vector"))
    vectors = placed.groupBy("vector").agg(F.count(F.lit(1)).alias("n"))
    visits = vectors.withColumn("at", F.col("vector"))
    for _ in range((max_bits + 1) // 2):
        visits = visits.select("vector", "n", F.explode(_one_step(F.col("at"), segments)).alias("at"))
    if max_bits > 2:
        visits = visits.distinct()  # several ways lead to one cell
    # distinct vectors near one cell are few, so no window is large
    here = Window.partitionBy("at")
    met = visits.withColumn("visitors", F.count(F.lit(1)).over(here)).where("visitors > 1 or n > 1").select("vector").distinct()
    return placed.join(met, "vector", "left_semi").select("fp")


def links(fps: DataFrame, max_bits: int = 2, segments: int = 32) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) that connect all
    those within ``max_bits`` bits: each link is between two such, and any two
    such are connected through links."""
    if segments not in (8, 16, 32):
        raise ValueError("segments must be 8, 16 or 32")
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0 to 4: the visits per fingerprint grow as 64 to the power of half of it")
    near, far = max_bits // 2, (max_bits + 1) // 2
    masks = F.array(*[F.struct(F.lit(m).alias("mask"), F.lit(r <= near).alias("near")) for m, r in _masks(far)])
    # exact check of those that the range join has left: visitors of one value are at most far + near bits apart
    visit = in_company(fps, max_bits, segments).select("fp", F.explode(masks).alias("m")) \
        .select("fp", F.col("m.near").alias("near"), F.col("fp").bitwiseXOR(F.col("m.mask")).alias("value"))
    groups = visit.groupBy("value").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("hub"), F.collect_set("fp").alias("all")) \
        .where("hub is not null and size(all) > 1")
    pairs = groups.select(F.col("hub").alias("u"), F.explode("all").alias("v")).where("u != v").distinct()
    return pairs.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, segments: int = 32) -> DataFrame:
    """Group documents whose SimHash fingerprints are connected by steps of at
    most ``max_bits`` differing bits.

    Returns one row per input row: id, ``fp`` (signed 64-bit), ``row`` (the
    text's key), ``n_rows`` (rows with the same fingerprint), ``component_id``
    (smallest id in the group) and ``keep`` (this row stands for the group: the
    smallest id, then the smallest text key; copies of that very row too).

    Defined cases: NULL, empty and white-space texts have fingerprint zero and
    are linked like others.  Repeated rows and ids are rows of their own; NULL
    ids count as larger than any other, so ``component_id`` is NULL only where
    all ids are.
    """
    rows = materialised(fingerprints(docs, id_col, text_col, shingle))
    least = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row")).alias("first")
    distinct = materialised(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n_rows"), least))
    comp = components(links(distinct.select("fp"), max_bits, segments))
    member = distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("group", F.coalesce("component", "fp"))
    first = member.groupBy("group").agg(F.min("first").alias("rep"))
    named = member.join(first, "group").select("fp", "n_rows", "rep")
    out = rows.join(named, "fp")
    same = F.col("id").eqNullSafe(F.col("rep.id")) & (F.col("row") == F.col("rep.row"))
    return out.select(F.col("id").alias(id_col), "row", "fp", "n_rows", F.col("rep.id").alias("component_id"),
                      same.alias("keep"))


def hex_fingerprint(fp: Column) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
