"""Benchmark decontamination: mark document words that repeat a benchmark.

Method: one Aho-Corasick automaton over the normalised benchmark texts scans
each document once; offsets of hits are mapped back to the original text.

Normalised text is the words (runs of ASCII letters and digits and of anything
beyond ASCII, A-Z lower-cased) with one space between and around them; it is
handled as UTF-8 bytes, one character a byte.  The automaton's patterns are the
benchmark's windows in that form, so a hit always ends at word borders.

No shuffle: the documents stay where they are read.  The benchmark is sent to
the tasks; its size is measured first, and a benchmark beyond ``block_bytes``
is dealt into blocks with one pass of the documents for each, so an automaton
never grows with the benchmark.
"""

from __future__ import annotations

import re
import uuid

import ahocorasick
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from postlake.llm.common import with_python_columns

# bytes: A-Z to a-z; ASCII other than letters and digits to a space; the rest unchanged
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                for b in range(256))
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")  # the same words, in an original text


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def windows(words: list[bytes], size: int) -> list[bytes]:
    """All runs of ``size`` words; a shorter text is one window, none if empty."""
    if not words:
        return []
    return [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


def build_automaton(items: list[tuple[object, str | None]], size: int) -> ahocorasick.Automaton | None:
    """Each pattern's value: its length in bytes with both spaces, its words,
    and the ids of the items that hold it."""
    found: dict[bytes, set] = {}
    for item, text in items:
        for w in windows(normal_words(text), size):
            found.setdefault(w, set()).add(item)
    if not found:
        return None
    auto = ahocorasick.Automaton()
    for w, ids in found.items():
        auto.add_word(f" {w.decode('latin-1')} ", (len(w) + 2, w.count(b" ") + 1, tuple(ids)))
    auto.make_automaton()
    return auto


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of word ranges (end exclusive), sorted."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def scan(text: str | None, auto: ahocorasick.Automaton | None) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, merged ranges of hit words, ids of the items hit."""
    words = normal_words(text)
    if auto is None or not words:
        return len(words), [], set()
    line = f" {b' '.join(words).decode('latin-1')} "
    spans, items, at, n = [], set(), 0, 0
    for end, (length, count, ids) in auto.iter(line):
        n += line.count(" ", at, end)  # a hit ends at the space after its last word: n words lie before it
        at = end
        if not spans or spans[-1] != (n - count, n):
            spans.append((n - count, n))
        items.update(ids)
    return len(words), merged(spans), items


_AUTOMATA: dict[object, object] = {}  # one automaton per block, kept while a Python worker lives


def _scanner(key: str, sent, size: int):
    def make():
        if key not in _AUTOMATA:
            _AUTOMATA.clear()
            _AUTOMATA[key] = build_automaton(sent.value, size)
        auto = _AUTOMATA[key]

        def run(texts, *before):
            n_words, n_hit, items_out, words_out, chars_out = [], [], [], [], []
            for k, text in enumerate(texts):
                n, spans, items = scan(text, auto)
                if before:
                    items |= set(before[0][k])
                    spans = merged(spans + [(s["start"], s["end"]) for s in before[1][k]])
                chars = []
                if spans:
                    at = [m.span() for m in WORD.finditer(text)]
                    chars = [{"start": at[a][0], "end": at[b - 1][1]} for a, b in spans]
                n_words.append(n)
                n_hit.append(sum(b - a for a, b in spans))
                items_out.append(sorted(x for x in items if x is not None))
                words_out.append([{"start": a, "end": b} for a, b in spans])
                chars_out.append(chars)
            return n_words, n_hit, items_out, words_out, chars_out
        return run
    return make


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", window: int = 10, block_bytes: int = 32 << 20,
                      keep: list[str] | None = None) -> DataFrame:
    """Which words of each document lie in a run of ``window`` words (or in a
    whole shorter text) of a benchmark item.

    Returns the input rows with the columns in ``keep`` (default: all) and
    ``n_words``, ``n_hit``, ``items`` (ids as strings, sorted), ``word_spans``
    and ``char_spans`` (hit ranges in words, and in code points of the
    original text; ends exclusive).  An input column of one of these names is
    replaced.

    Defined cases: a NULL or empty text has no words; an item without words
    has no windows; the windows of an item whose id is NULL mark words but
    the item is not listed; repeated items count once; with an empty
    benchmark nothing is hit.  ``block_bytes`` bounds what is sent to the
    tasks at once, in bytes of distinct items, text and id (one item may exceed
    it alone); a text that many ids share is dealt over the blocks with them.
    """
    spark = docs.sparkSession
    items = benchmark.select(benchmark[item_col].cast("string").alias("item"),
                             benchmark[item_text_col].alias("text")).where("text is not null").distinct()
    size = F.octet_length("text") + F.coalesce(F.octet_length("item"), F.lit(0))
    total = items.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    span = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
    schema = StructType([StructField("n_words", LongType()), StructField("n_hit", LongType()),
                         StructField("items", ArrayType(StringType())), StructField("word_spans", span),
                         StructField("char_spans", span)])
    keep = list(docs.columns if keep is None else keep)
    df = docs
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("text", "item"), F.lit(blocks)) == b) if blocks > 1 else items
        sent = spark.sparkContext.broadcast([tuple(r) for r in part.collect()])
        last = b == blocks - 1
        cols = keep if last else list(dict.fromkeys([*keep, text_col]))
        df = with_python_columns(df, [text_col, *(["items", "word_spans"] if b else [])], schema,
                                 _scanner(uuid.uuid4().hex, sent, window), keep=cols)
    return df
