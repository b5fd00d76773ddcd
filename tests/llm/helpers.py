"""Small tables with awkward rows, and brute-force versions of the operators."""

import re
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NORMAL = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, texts, **columns):
    """Documents numbered from 0 with the given texts."""
    rows = [(i, t, columns.get("lang", ["en"] * len(texts))[i], columns.get("source", ["s"] * len(texts))[i],
             None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    """NULLs in every column, empty and blank texts, a very long one, ties and
    repeated rows, and columns whose names the operators use themselves."""
    long = "very long text with many words " * 20_000
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n \x0b ", "en", "a", 6), (None, "text of nobody", "en", None, 14),
            (None, None, None, None, None), (4, long, "en", "a", len(long)), (5, "same text here for ties", "en", "b", 23),
            (5, "same text here for ties", "en", "b", 23), (6, "same text here for ties", "fr", "b", 23),
            (6, "another text under the same id", "fr", "b", 30), (7, "\U0001f600 é ß İ   \x00 end", "de", "b", 10)]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F
    for name in ("id", "row", "th", "h", "key", "u", "v", "items", "n_words", "size", "kept_text", "doc", "found", "score",
                 "lang_pred", "matches", "stratum", "copies", "component_id", "__in0"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def components(n, linked):
    """Smallest member reachable, for items 0 to n - 1."""
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return label


def repeated_windows(text):
    w = WORD.findall(text or "")
    seen, hit = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if seen[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return len(hit)


def hits(text, items, size=10):
    """Hit words and items of a text, window by window."""
    w = NORMAL.findall((text or "").translate(AZ))
    marked, found = set(), set()
    for item, t in items:
        v = NORMAL.findall((t or "").translate(AZ))
        for a in range(max(1, len(v) - size + 1)) if v else ():
            win = v[a:a + size]
            for i in range(len(w) - len(win) + 1):
                if w[i:i + len(win)] == win:
                    marked |= set(range(i, i + len(win)))
                    if item is not None:
                        found.add(str(item))
    return len(w), len(marked), sorted(found)


def line_dedup(rows, min_chars=20, min_docs=3):
    """(id, text) rows to (id, lines, dropped, kept text)."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(AZ)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or i == max(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out
