"""Spelling variant grouping: words one edit apart, and the frequent form each goes to.

Method: bidirectional FM-index search schemes.  A word one edit away from
another agrees with it in one half.  The index is a pair of FM-indexes, over the
delimited words and over the same text reversed, whose suffix-rank intervals are
kept in step: the half is matched exactly from its inner end out to the
delimiter, then the search turns round and goes on across the other half,
allowing one error, to the closing delimiter.  The work of a search depends on
the intervals it keeps alive, not on how many words share the half.

The vocabulary is dealt twice, by words and by reversed words, into blocks of
neighbours in sorted order; each block is one small index.  Words that agree
with a query in its exact half stand together in that order, so a query goes to
its own block and to those that begin or end with the same half (an equality
join on prefixes of the blocks' first and last words).  The queries of a block
are dealt out in slices, so that no task holds more than a block and a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from postlake.llm.common import materialised

#: Delimiter and end of the text in an index; letters follow.
END, EDGE = 0, 1
#: Blocks are chosen by this many first code points at most.
LEAD = 32


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in sorted order, by prefix doubling."""
    n, bits = len(text), int(text.max()).bit_length()
    width = max(1, 62 // bits)
    rank = np.zeros(n, np.int64)
    padded = np.concatenate([text, np.zeros(width, text.dtype)])
    for k in range(width):
        rank = rank << bits | padded[k:k + n]
    while True:
        order = np.argsort(rank, kind="stable")
        ordered = rank[order]
        dense = np.empty(n, np.int64)
        dense[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if dense[order[-1]] == n - 1:
            return order
        later = np.zeros(n, np.int64)
        later[:max(0, n - width)] = dense[width:] + 1
        rank, width = dense * (n + 1) + later, width * 2


class Direction:
    """The FM-index of one text: extends intervals of suffix ranks by the
    symbol before them.  The symbols stand in a wavelet matrix, which counts in
    one pass those equal to and those smaller than a given one."""

    def __init__(self, text: np.ndarray):
        self.order = suffix_order(text)
        column = text[self.order - 1]
        self.size, self.levels, sigma = len(text), int(text.max()).bit_length(), int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.ones = []
        for level in range(self.levels - 1, -1, -1):
            bit = (column >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            column = np.concatenate([column[bit == 0], column[bit == 1]])
        symbols = np.arange(sigma)
        self.base = self._down(np.zeros(sigma, np.int64), np.full(sigma, self.size), symbols)[0]

    def _down(self, lo: np.ndarray, hi: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        less = np.zeros(len(c), np.int64)
        for ones, level in zip(self.ones, range(self.levels - 1, -1, -1)):
            one_lo, one_hi = ones[lo], ones[hi]
            right = (c >> level) & 1 == 1
            less += np.where(right, hi - lo - (one_hi - one_lo), 0)
            zeros = self.size - ones[-1]
            lo, hi = np.where(right, zeros + one_lo, lo - one_lo), np.where(right, zeros + one_hi, hi - one_hi)
        return lo, hi, less

    def extend(self, lo: np.ndarray, size: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals after putting ``c`` in front, their sizes, and how many
        occurrences had a smaller symbol there.  A symbol of -1 is not in the text."""
        known = np.maximum(c, 0)
        a, b, less = self._down(lo, lo + size, known)
        return self.first[known] + a - self.base[known], np.where(c < 0, 0, b - a), less


class Index:
    """Both directions over ``words``, each between delimiters."""

    def __init__(self, words: list[str]):
        flat = np.frombuffer("\n".join(["", *words, ""]).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])  # of the delimiters
        edge = np.zeros(len(flat), bool)
        edge[starts] = True
        self.letters = np.unique(flat[~edge])
        text = np.where(edge, EDGE, np.searchsorted(self.letters, flat) + 2).astype(np.int64)
        self.n, self.words = len(text), words
        self.left = Direction(np.concatenate([text, [END]]))
        self.right = Direction(np.concatenate([text[::-1], [END]]))
        self.word_at = np.full(self.n, -1, np.int64)  # by the delimiter before it
        self.word_at[starts[:-1]] = np.arange(len(words))

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' symbols, each word closed by a delimiter, and their offsets."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        at = np.concatenate([[0], np.cumsum(lengths + 1)])
        flat = np.frombuffer("".join(w + "\n" for w in words).encode("utf-32-le"), np.uint32)
        spot = np.minimum(np.searchsorted(self.letters, flat), max(len(self.letters) - 1, 0))
        out = np.where(self.letters[spot] == flat, spot + 2, -1) if len(self.letters) else np.full(len(flat), -1)
        out[at[1:] - 1] = EDGE
        return out, at

    def word_before(self, rank: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The word whose delimiter opens the match of ``length`` symbols at a
        rank of the reversed text."""
        return self.word_at[self.n - self.right.order[rank] - length]


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one code point was inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def search(index: Index, queries: list[str], exact: list[int]) -> Iterator[tuple[int, int]]:
    """Pairs (query, indexed word) one edit apart that agree in the query's
    first ``exact`` code points; each pair once.

    An edit has one canonical place, the last one that gives the same word, so
    no two searches end at the same pair.  A search with a single occurrence
    left is settled by comparing what remains of the two words.
    """
    if not queries or not index.words:
        return
    symbols, at = index.encode(queries)
    half = np.asarray(exact, np.int64)
    q = np.arange(len(queries))
    # the exact half from its inner end out to the delimiter: both intervals in step
    lo, lo_r, size = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.full(len(q), index.n + 1)
    step = 0
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(q):
        inner = half[q] - 1 - step
        c = np.where(inner >= 0, symbols[at[q] + np.maximum(inner, 0)], EDGE)
        lo, new, less = index.left.extend(lo, size, c)
        lo_r, size = lo_r + less, new
        alive = size > 0
        over = alive & (inner < 0)
        done.append((q[over], lo_r[over], size[over]))
        on = alive & (inner >= 0)
        q, lo, lo_r, size, step = q[on], lo[on], lo_r[on], size[on], step + 1
    q, lo, size = (np.concatenate(x) for x in zip(*done))

    # turn round: one symbol at a time across the other half
    j, used = half[q], half[q] + 1  # next symbol of the query; symbols of the match
    sigma = np.arange(2, len(index.letters) + 2)
    erring: list[tuple[np.ndarray, ...]] = []

    def keep(q: np.ndarray, lo: np.ndarray, size: np.ndarray, j: np.ndarray, used: np.ndarray) -> None:
        on = size > 0
        erring.append((q[on], lo[on], size[on], j[on], used[on]))

    while len(q):
        single = size == 1
        for k, w in zip(q[single].tolist(), index.word_before(lo[single], used[single]).tolist()):
            if one_edit(queries[k], index.words[w]):
                yield k, w
        q, lo, size, j, used = (x[~single] for x in (q, lo, size, j, used))
        x = symbols[at[q] + j]
        for i in range(0, len(q), 4096):  # every other letter, replaced or put in
            s = slice(i, i + 4096)
            many = [np.repeat(v[s], len(sigma)) for v in (q, lo, size, j, used, x)]
            c = np.tile(sigma, len(q[s]))
            m_lo, m_size, _ = index.right.extend(many[1], many[2], c)
            other = (c != many[5]) & (m_size > 0)
            for keeps, ahead in ((other & (many[5] != EDGE), 1), (other, 0)):
                keep(many[0][keeps], m_lo[keeps], m_size[keeps], many[3][keeps] + ahead, many[4][keeps] + 1)
        dropped = x != EDGE
        dropped[dropped] = x[dropped] != symbols[(at[q] + j + 1)[dropped]]
        keep(q[dropped], lo[dropped], size[dropped], j[dropped] + 1, used[dropped])
        go = x != EDGE
        q, lo, size, j, used, x = (v[go] for v in (q, lo, size, j, used, x))
        lo, size, _ = index.right.extend(lo, size, x)
        on = size > 0
        q, lo, size, j, used = q[on], lo[on], size[on], j[on] + 1, used[on] + 1

    if not erring:
        return
    q, lo, size, j, used = (np.concatenate(x) for x in zip(*erring))
    while len(q):
        single = size == 1
        last = index.word_before(lo[single], used[single]).tolist()
        for k, w, a, b in zip(q[single].tolist(), last, j[single].tolist(), used[single].tolist()):
            if queries[k][a:] == index.words[w][b - 1:]:
                yield k, w
        q, lo, size, j, used = (x[~single] for x in (q, lo, size, j, used))
        x = symbols[at[q] + j]
        lo, size, _ = index.right.extend(lo, size, x)
        ended = (x == EDGE) & (size > 0)  # words are distinct, so one occurrence
        yield from zip(q[ended].tolist(), index.word_before(lo[ended], used[ended] + 1).tolist())
        on = (x != EDGE) & (size > 0)
        q, lo, size, j, used = q[on], lo[on], size[on], j[on] + 1, used[on] + 1


def _block_pairs(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """One block's index against a slice of its queries."""
    keys, words = entries["key"].tolist(), queries["word"].tolist()
    found = list(search(Index(keys), words, queries["exact"].tolist())) if keys and words else []
    n = entries["n"].to_numpy()
    backward = bool(len(entries)) and bool(entries["backward"].iloc[0])
    rows = []
    for k, w in found:
        a, b = (words[k][::-1], keys[w][::-1]) if backward else (words[k], keys[w])
        if not (backward and b.startswith(a[:len(a) // 2])):  # those are found forward
            rows.append((a, b, int(n[w])))
    return pd.DataFrame(rows, columns=["word", "near", "near_n"])


def near_words(words: DataFrame, block_symbols: int = 1 << 17, slice_queries: int = 1 << 14) -> DataFrame:
    """All ordered pairs of ``words`` (word, n) that are one edit apart:
    ``word``, ``near``, ``near_n``.  Words must be distinct and not NULL."""
    both = words.select(F.lit(False).alias("backward"), F.col("word").alias("key"), "n", F.length("word").alias("len")) \
        .unionByName(words.select(F.lit(True).alias("backward"), F.reverse("word").alias("key"), "n",
                                  F.length("word").alias("len")))
    both = both.withColumn("lead", F.substring("key", 1, LEAD))
    by = ["backward", "lead", "key"]
    rows = both.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("seq", F.monotonically_increasing_id())
    before = Window.partitionBy("backward", F.shiftright("seq", 33)).orderBy("seq")
    symbols = F.sum(F.col("len") + 1).over(before) - F.col("len") - 1
    rows = materialised(rows.select("backward", F.shiftright("seq", 33).alias("task"),
                                    F.floor(symbols / block_symbols).cast("long").alias("part"), "key", "lead", "len", "n"))
    # code points of the half that must agree: the shorter one forward, the longer one backward
    exact = F.floor((F.col("len") + F.when(F.col("backward"), 1).otherwise(0)) / 2).cast("int")
    block = ["backward", "task", "part"]
    own = rows.select(*block, "key", exact.alias("exact"))

    # blocks that begin or end with a prefix
    ends = rows.groupBy(*block).agg(F.min("lead").alias("lo"), F.max("lead").alias("hi"))
    edges = ends.select(*block, F.explode(F.array("lo", "hi")).alias("end")) \
        .select(*block, F.explode(F.transform(F.sequence(F.lit(0), F.length("end")),
                                              lambda k: F.substring("end", 1, k))).alias("prefix")).distinct()
    asked = own.select(*block, "key", "exact", F.expr(f"substring(key, 1, least(exact, {LEAD}))").alias("prefix"))
    others = asked.alias("a").join(edges.alias("e"), (F.col("a.backward") == F.col("e.backward"))
                                   & (F.col("a.prefix") == F.col("e.prefix"))
                                   & ((F.col("a.task") != F.col("e.task")) | (F.col("a.part") != F.col("e.part")))) \
        .select("e.backward", "e.task", "e.part", "a.key", "a.exact")
    queries = own.unionByName(others)
    slices = queries.groupBy(*block).agg(F.ceil(F.count(F.lit(1)) / slice_queries).cast("int").alias("slices"))
    slices = materialised(slices)
    tasks = (slices.agg(F.sum("slices")).first()[0] or 0) // 2 + 1  # little data, much work: AQE would put all in a few
    queries = queries.join(slices, block).withColumn("slice", F.pmod(F.xxhash64("key"), F.col("slices")).cast("int"))
    entries = rows.join(slices, block).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    group = [*block, "slice"]
    asks = [f"q_{c}" for c in group]
    queries = queries.select(*[F.col(c).alias(a) for c, a in zip(group, asks)], F.col("key").alias("word"), "exact")
    return entries.select(*group, "key", "n").repartition(tasks, *group).groupBy(*group) \
        .cogroup(queries.repartition(tasks, *asks).groupBy(*asks)) \
        .applyInPandas(_block_pairs, "word string, near string, near_n long")


def group_variants(words: DataFrame, ratio: int = 10, block_symbols: int = 1 << 17,
                   slice_queries: int = 1 << 14) -> DataFrame:
    """The form each word of ``words`` (``word``, ``n``) goes to.

    Two words are near if they differ by exactly one inserted, deleted or
    replaced code point.  A word's ``form`` is its most frequent near word
    (ties: the first in code-point order), if that is ``ratio`` times as
    frequent or more; ``root`` is where the forms lead in the end.

    Returns one row per distinct word: ``word``, ``form`` (or NULL), ``root``
    (the word itself if it has no form), ``n``, ``n_near``, ``form_n``.

    Defined cases: NULL words and a NULL ``n`` are left out; a repeated word
    counts with the sum of its rows.  The empty word is a word.  Words of any
    length are compared whole.  An empty table gives an empty result; other
    columns are ignored.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more: forms could lead in a circle")
    words = materialised(words.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word")
                         .agg(F.sum("n").cast("long").alias("n")))
    best = near_words(words, block_symbols, slice_queries).groupBy("word") \
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("top"))
    held = F.col("top.minus") * -1 >= F.col("n") * ratio
    formed = materialised(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(held, F.col("top.near")).alias("form"), F.when(held, -F.col("top.minus")).alias("form_n")))

    # follow the forms, twice as far each round; n grows by the ratio with each step, so rounds are few
    step = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        then = step.select(F.col("word").alias("via"), F.col("root").alias("further"))
        longer = materialised(step.join(then, F.col("root") == F.col("via"), "left")
                              .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        step = longer.select("word", "root")
        if not longer.agg(F.max("moved")).first()[0]:
            break
    return formed.join(step, "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def letter_runs(text: Column, least: int) -> Column:
    """The maximal runs of ASCII and Latin-1 letters (U+00C0 to U+00FF) with
    ``least`` code points or more; NULL has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{least},}}"), F.lit(0))
