"""Spelling variants against all pairs compared by hand."""

import random
import zlib
from collections import Counter
import re

import pytest

from postlake.llm import queries, spelling
from tests.llm.helpers import AZ, SCHEMA, awkward


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=10):
    rows, form = {}, {}
    for w, n in counts.items():
        others = [t for t in counts if near(w, t)]
        best = min(others, key=lambda t: (-counts[t], t), default=None)
        if best is not None and counts[best] >= ratio * n:
            form[w] = best
        rows[w] = len(others)

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w), root(w), counts[w], rows[w], counts[form[w]] if w in form else None) for w in counts)


def run(words, **options):
    out = spelling.group_variants(words, **options)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in out.collect())


def words(rng, n, letters, longest):
    return list({"".join(rng.choice(letters) for _ in range(rng.randint(0, longest))) for _ in range(n)})


@pytest.mark.parametrize("letters", ["ab", "abcé\U0001f600\n"])
def test_index_finds_every_pair_once(letters):
    rng = random.Random(len(letters))
    for _ in range(60):
        all_words = words(rng, rng.randint(1, 60), letters, 7)
        part = all_words[:rng.randint(1, len(all_words))]
        exact = [len(w) // 2 for w in all_words]
        got = list(spelling.search(spelling.Index(part), all_words, exact))
        assert sorted(got) == sorted((i, j) for i, w in enumerate(all_words) for j, t in enumerate(part)
                                     if near(w, t) and t.startswith(w[:exact[i]]))


def test_intervals_are_those_of_the_sorted_suffixes():
    index = spelling.Index(["banana", "bandana", "ananas"])
    for d in (index.left, index.right):
        assert sorted(d.order.tolist()) == list(range(d.size))


@pytest.mark.parametrize("options", [{}, {"block_symbols": 40, "slice_queries": 3}])
def test_groups_equal_brute_force(spark, options):
    rng = random.Random(5)
    counts = {w: rng.choice([1, 2, 3, 40, 500, 6000]) for w in words(rng, 250, "abcé", 6)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert run(df, **options) == brute(counts)


def test_a_hot_prefix_in_many_blocks(spark):
    counts = {"commonprefix" + a + b: (ord(a) * 7 + ord(b)) % 90 + 1 for a in "abcdefgh" for b in "abcdefgh"}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert run(df, block_symbols=64, slice_queries=5) == brute(counts)


def test_defined_cases(spark):
    schema = "word string, n long, form string"
    rows = [(None, 5, "x"), ("lone", None, "x"), ("", 3, "x"), ("a", 60, "x"), ("a", 40, "x"), ("b", 1, None)]
    assert run(spark.createDataFrame(rows, schema)) == brute({"": 3, "a": 100, "b": 1})
    assert run(spark.createDataFrame([], schema)) == []
    with pytest.raises(ValueError):
        spelling.group_variants(spark.createDataFrame(rows, schema), ratio=1)


def test_very_long_words(spark):
    long = "".join(random.Random(1).choice("abc") for _ in range(50_000))
    counts = {long: 1000, long[:7] + "d" + long[8:]: 50, long[1:]: 3, long[:-2]: 2, "a" * 3000: 30, "a" * 3001: 3, "a" * 3002: 400}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = {long: None, long[:7] + "d" + long[8:]: long, long[1:]: long, long[:-2]: None,
            "a" * 3000: "a" * 3001 if 3 >= 300 else None, "a" * 3001: "a" * 3002, "a" * 3002: None}
    assert {r[0]: r[1] for r in run(df)} == want


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeÀé÷") for _ in range(rng.randint(6, 9))) for _ in range(12)]
    texts = [" ".join(rng.choice(vocabulary).title() for _ in range(60)) + ".x1y\n" for _ in range(60)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(999, None, None, None, None), (1000, "", "en", "s", 0)]
    rows += [(None, " ".join(vocabulary), "en", "s", 9)] * 40
    spark.createDataFrame(rows, SCHEMA).unionByName(awkward(spark).select(SCHEMA.replace(" long", "").replace(" string", "").split(", "))) \
        .write.parquet(str(tmp_path / "documents.parquet"))
    counts = Counter()
    for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect():
        for w in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            w = w.translate(AZ)
            if r["doc_id"] is not None and (h := zlib.crc32(f"{r['doc_id']}:{w}".encode())) % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                counts[w] += 1
    got = queries.op11_spelling_variants(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == brute({w: n for w, n in counts.items() if n >= 2})
