"""SimHash and substring near-duplicates, components, mixing, secrets and
personal data against brute force, planted cases and awkward rows."""

import math
import os
import random
import re
import string

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from helpers import awkward, components as brute_components, frame
from postlake.llm import licenses, mixing, pii, secret_scan, shingles, simhash, substring_dedup
from postlake.llm.components import components


def _simhash(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_equals_the_definition(monkeypatch):
    rnd = random.Random(1)
    monkeypatch.setattr(simhash, "CHUNK", 7)  # a text's shingles are summed over chunks
    for t in (None, "", " ", "One", "ONE two", "a b c", "É é\x0bx y z", *(" ".join(rnd.choice("abcdeF") for _ in range(n)) for n in range(3, 60))):
        assert simhash.fingerprint(t) % (1 << 64) == _simhash(t)


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
def test_links_connect_what_brute_force_links(spark, max_bits):
    rnd = random.Random(max_bits)
    base = [rnd.getrandbits(64) for _ in range(15)]
    values = sorted({b ^ sum(1 << x for x in rnd.sample(range(64), rnd.randint(0, 4))) for b in base for _ in range(8)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = simhash.links(fps, max_bits, segments=8 if max_bits == 1 else 32).collect()
    at = {v: i for i, v in enumerate(signed)}
    near = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= max_bits]
    assert {(max(at[u], at[v]), min(at[u], at[v])) for u, v in got} <= set(near)
    assert brute_components(len(values), [(at[u], at[v]) for u, v in got]) == brute_components(len(values), near)


def test_popcount_distance_is_a_lower_bound(spark):
    rnd = random.Random(9)
    rows = [(rnd.getrandbits(63), rnd.getrandbits(63)) for _ in range(50)]
    for segments in (8, 16, 32):
        width = 64 // segments
        df = spark.createDataFrame(rows, "a long, b long").select("a", "b", simhash.cell(F.col("a"), segments).alias("c"))
        for a, b, c in df.collect():
            def vector(x):
                return [(x >> (i * width) & ((1 << width) - 1)).bit_count() for i in range(segments)]
            assert [(c % (1 << 64)) >> (i * width) & ((1 << width) - 1) for i in range(segments)] == vector(a)
            assert sum(abs(p - q) for p, q in zip(vector(a), vector(b))) <= (a ^ b).bit_count()


def test_near_duplicates_of_a_hot_group(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words)] * 120 + [" ".join(words[:i] + ["changed"] + words[i + 1:]) for i in range(0, 400, 8)]
    texts += [" ".join(rnd.choice(words) for _ in range(50)) for _ in range(40)]
    rnd.shuffle(texts)
    out = {r["doc_id"]: r for r in simhash.near_duplicates(frame(spark, texts)).collect()}
    fp = [_simhash(t) for t in texts]
    want = brute_components(len(texts), [(i, j) for i in range(len(fp)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 2])
    assert [out[i]["component_id"] for i in range(len(texts))] == want
    assert [out[i]["keep"] for i in range(len(texts))] == [i == c for i, c in enumerate(want)]


def test_near_duplicates_awkward_rows(spark):
    df = awkward(spark)
    out = simhash.near_duplicates(df).collect()
    assert len(out) == df.count()
    by = {r["doc_id"]: r for r in out}
    assert by[1]["fp"] == by[2]["fp"] == by[3]["fp"] == 0 and by[3]["component_id"] == 1
    assert {r["component_id"] for r in out if r["fp"] == by[5]["fp"]} == {5}
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_random_graphs_and_a_long_chain(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 380)] + [(7, 7)]
    edges += [(500, i) for i in range(501, 700)]
    want = brute_components(700, edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges + [(None, 1)], "u long, v long")).collect()}
    touched = {x for e in edges for x in e if e[0] != e[1]}
    assert got == {i: want[i] for i in touched}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def _passage(rnd, n):
    return ["".join(rnd.choice(string.ascii_lowercase) for _ in range(5)) for _ in range(n)]


def test_compact_windows_hold_each_minimum():
    rng = np.random.default_rng(5)
    for v in (rng.integers(0, 1 << 60, 40, dtype=np.uint64), rng.integers(0, 4, 40).astype(np.uint64), np.zeros(20, np.uint64)):
        got = substring_dedup.compact_windows(v, 6)
        for a in range(len(v)):
            for b in range(a + 5, len(v)):
                inside = [w for w in got if w[0] <= a <= w[1] <= b <= w[2]]
                assert len(inside) == 1 and inside[0][1] == a + int(v[a:b + 1].argmin())


def test_repeated_passages(spark):
    rnd = random.Random(6)
    exact, changed, twice = _passage(rnd, 55), _passage(rnd, 120), _passage(rnd, 60)
    texts = []
    for i in range(12):
        p = exact if i < 4 else changed if i < 8 else []
        if 5 <= i < 8:
            p = p[:60] + [f"new{i}"] + p[61:]  # a word in the middle of 120 words
        texts.append(" ".join(_passage(rnd, 80 + i) + [w.upper() + "," for w in p] + _passage(rnd, 70)))
    texts += [" ".join(exact[:30]), None, "", " ".join(twice + _passage(rnd, 20) + twice), "short copy", "short copy",
              " ".join(_passage(rnd, 52))] * 1
    texts += [texts[-1]]
    out = {r["doc_id"]: r for r in substring_dedup.repeated_passages(frame(spark, texts)).collect()}
    comp = [out[i]["component_id"] for i in range(len(texts))]
    assert comp[:12] == [0] * 4 + [4] * 4 + [8, 9, 10, 11]
    assert comp[12:18] == [12, 13, 14, 15, 16, 17] and comp[18:] == [18, 18]
    for i in range(4):
        (s,) = out[i]["spans"]
        found = texts[i][s["start"]:s["end"]].replace(",", "").lower().split()
        assert " ".join(found) in " ".join(exact) and len(found) >= 45
    assert all(len(out[i]["spans"]) == 0 for i in range(8, 12))


def test_passages_around_one_change_in_the_middle_are_compared():
    rnd = random.Random(7)
    w = [x.encode() for x in _passage(rnd, 91)]
    a = substring_dedup.shingle_hashes(w)
    w2 = list(w)
    w2[20] = b"other"
    b = substring_dedup.shingle_hashes(w2)
    assert substring_dedup.similar(a, 45, b, 45) is not None
    w2[60] = w2[35] = w2[50] = b"more"
    c = substring_dedup.shingle_hashes(w2)
    assert substring_dedup.similar(a, 44, c, 44) is None


@pytest.mark.parametrize("word", [0, 7, 22, 49])
def test_changed_passages_of_50_words_are_found_at_every_offset(word):
    rnd = random.Random(word)
    same = [x.encode() for x in _passage(rnd, 50)]
    other = same[:word] + [b"other"] + same[word + 1:]
    a, b = ([x.encode() for x in _passage(rnd, 60)] + p + [x.encode() for x in _passage(rnd, 60)] for p in (same, other))
    s, t = substring_dedup.shingle_hashes(a), substring_dedup.shingle_hashes(b)
    shared = [c for c in range(60, 60 + substring_dedup.PASSAGE) if s[c] == t[c]]
    assert len(shared) == substring_dedup.PASSAGE - len(range(max(0, word - 4), min(45, word) + 1))
    for c in shared:
        got = substring_dedup.similar(s[c - 45:c + 46], 45, t[c - 45:c + 46], 45)
        assert got is not None and (1 <= word <= 48) <= (got == (105 - c, 105 - c)), (c, got)


def test_overlaps_equal_sets_of_shingles():
    rng = np.random.default_rng(15)
    for high in (40, 400, 1 << 40):
        for _ in range(30):
            a, b = rng.integers(0, high, 91, dtype=np.uint64), rng.integers(0, high, 80, dtype=np.uint64)
            b[20:70] = a[25:75]
            both, every = substring_dedup._overlaps(a, 45, b, 40, 11, 40)
            for x in range(11, 41):
                p, q = set(a[45 - x:91 - x].tolist()), set(b[40 - x:86 - x].tolist())
                assert (both[x - 11], every[x - 11]) == (len(p & q), len(p | q))


def _around_a_phrase(rnd, pairs):
    """Pairs of near-duplicate passages of 50 words that all hold one phrase of
    30 words, found in all of them by a minimum in the phrase and by no other."""
    def least(phrase):
        s = substring_dedup.shingle_hashes([w.encode() for w in phrase])[8:-8]
        return max(int(substring_dedup._mix(s + substring_dedup._seed(j + 1)).min()) for j in range(substring_dedup.FUNCTIONS))
    phrase = min((_passage(rnd, 30) for _ in range(3000)), key=least)
    out = []
    for i in range(pairs):
        left, right = _passage(rnd, 10), _passage(rnd, 10)
        out.append([left + phrase + right, left + phrase + right[:4] + [f"new{i}"] + right[5:]])
    return out


def test_every_variant_in_a_component_is_compared(spark):
    rnd = random.Random(20)
    footer = _passage(rnd, 60)
    texts = []
    for one, two in _around_a_phrase(rnd, 8):
        texts.append(" ".join(_passage(rnd, 70) + one + _passage(rnd, 70) + footer))
        texts.append(" ".join(two))  # no room for a window around another minimum
    out = substring_dedup.repeated_passages(frame(spark, texts)).collect()
    assert [r["component_id"] for r in out] == [0] * len(texts)


def test_all_pairs_of_a_group_are_linked_whatever_the_hubs(spark):
    """One group in which only pairs are alike; a hub is unlike nearly all."""
    rnd = random.Random(21)
    rows = []
    for i, (one, two) in enumerate(_around_a_phrase(rnd, 12)):
        for k, words in enumerate((one, two)):
            s = substring_dedup.shingle_hashes([w.encode() for w in words])
            n = 2 * i + k
            rows.append((n, n, n, n, 20, s.view(np.int64).tolist(), [7, 100 + n]))
    around = spark.createDataFrame(rows, "w long, th long, own long, comp long, at int, s array<long>, subs array<long>")
    got = {tuple(sorted((r["w"], r["v"]))) for r in substring_dedup._compared(around).collect()}
    assert got == {(2 * i, 2 * i + 1) for i in range(12)}


def test_many_pairs_are_compared_in_parts(spark, monkeypatch):
    """All pairs of one group, more at a time than surroundings: all are found,
    and no part writes its shuffle files beside those of another."""
    rnd = random.Random(30)
    rows = []
    for n, words in enumerate(w for pair in _around_a_phrase(rnd, 6) for w in pair):
        s = substring_dedup.shingle_hashes([w.encode() for w in words])
        rows.append((n, n, n, n, 20, s.view(np.int64).tolist(), [7]))
    around = spark.createDataFrame(rows, "w long, th long, own long, comp long, at int, s array<long>, subs array<long>")
    pairs = around.select("w").crossJoin(around.select(F.col("w").alias("v"))).where("w < v") \
        .withColumn("c_w", F.col("w")).withColumn("c_v", F.col("v"))
    folders, write = [], substring_dedup.scratch_path

    def path(*parts, **kw):
        folders.append(parts[2])
        return write(*parts, **kw)
    monkeypatch.setattr(substring_dedup, "scratch_path", path)
    monkeypatch.setattr(substring_dedup, "_PAIRS", 30, raising=False)
    got = sorted((r["w"], r["v"]) for r in substring_dedup._near(pairs, around, None).collect())
    assert got == [(2 * i, 2 * i + 1) for i in range(6)]
    assert folders.count("changed") == 3  # 66 pairs, 30 at a time


def test_changed_passages_inside_a_component_have_spans(spark):
    rnd = random.Random(22)
    footer = _passage(rnd, 60)
    planted = [p for pair in _around_a_phrase(rnd, 4) for p in pair]
    texts = [" ".join(_passage(rnd, 70) + p + _passage(rnd, 70) + footer) for p in planted]
    for r in substring_dedup.repeated_passages(frame(spark, texts)).collect():
        assert r["component_id"] == 0
        text, passage = texts[r["doc_id"]], " ".join(planted[r["doc_id"]])
        for part in (passage, " ".join(footer)):
            at = text.index(part)
            # a 45-word run is enough for a span, so up to a grid step is missing at each end
            assert any(s["start"] <= at + 40 and s["end"] >= at + len(part) - 40 for s in r["spans"]), (r, at)


def test_exact_copies_repeat_as_a_whole(spark):
    rnd = random.Random(24)
    text = " \n\u00a0\u00e9 " + " ".join(_passage(rnd, 55)) + "\t "
    out = substring_dedup.repeated_passages(frame(spark, [text, text, " ".join(_passage(rnd, 55)), None, "short", "short"])).collect()
    by = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in out}
    assert by == {0: [(2, len(text) - 2)], 1: [(2, len(text) - 2)], 2: [], 3: [], 4: [], 5: []}


def test_repeated_passages_leave_no_superseded_tables_and_no_shuffle_files(spark, monkeypatch):
    """Rounds of changed passages: what only the rounds read goes, and so do
    the shuffle files of each step."""
    rnd = random.Random(24)
    folders, write = [], substring_dedup.scratch_path

    def path(*parts, **kw):
        folders.append(write(*parts, **kw))
        return folders[-1]
    monkeypatch.setattr(substring_dedup, "scratch_path", path)
    texts = [" ".join(_passage(rnd, 30) + p + _passage(rnd, 30)) for pair in _around_a_phrase(rnd, 4) for p in pair]
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = manager.getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))
    out = substring_dedup.repeated_passages(frame(spark, texts))
    before = shuffles()
    again = substring_dedup._write(frame(spark, texts).repartition(3, "doc_id"), "again")
    assert shuffles() <= before and again.count() == len(texts)
    assert [len(r["spans"]) for r in out.orderBy("doc_id").collect()] == [1] * len(texts)
    written = {f.rsplit("/", 1)[1].rsplit("-", 1)[0]: 0 for f in folders}
    for f in folders:
        written[f.rsplit("/", 1)[1].rsplit("-", 1)[0]] += os.path.isdir(f.removeprefix("file://"))
    assert {"groups", "around", "shingles", "runs", "kept"} <= set(written)
    assert not any(written[n] for n in ("groups", "around", "shingles", "runs")) and written["kept"] == 1


def test_sub_keys_are_those_of_the_minima_of_each_side():
    rnd = np.random.default_rng(25)
    s = rnd.integers(0, 1 << 63, 300).astype(np.uint64)
    p, of = np.array([0, 7, 30, 45, 150, 290, 299]), np.array([0, 1, 2, 2, 3, 4, 5, 6])
    key = np.array([1, 2, 3, 4, -5, 6, 7, 8])
    subs, sizes = substring_dedup._sub_keys(s, p, of, key)
    low = [substring_dedup._mix(s + substring_dedup._seed(101 + j)) for j in range(substring_dedup.SUB_FUNCTIONS)]
    at, names = 0, {}
    for i, x in enumerate(p.tolist()):
        lo, hi = max(0, x - 45), min(300, x + 46)
        want = [(k, side, j, int(v[a:b].min())) for k in key[of == i].tolist()
                for side, (a, b) in enumerate(((lo, x - 8), (x + 9, hi), (max(lo, x - 23), x - 8), (x + 9, min(hi, x + 23))))
                if b - a >= 5 for j, v in enumerate(low)]
        assert sizes[i] == len(want)
        for got, name in zip(subs[at:at + len(want)].tolist(), want):
            assert names.setdefault(got, name) == name
        at += len(want)
    assert at == len(subs) == len(names)


def test_changed_passage_across_blocks_of_a_long_text(spark):
    """The changed passages lie on both sides of a block's border in one text."""
    rnd = random.Random(26)
    pairs = _around_a_phrase(rnd, 4)
    size = substring_dedup._BLOCK
    long, at = [], []
    for k, (one, _) in enumerate(pairs):
        long += _passage(rnd, (k + 1) * size - 15 * k - len(long) - 20)
        at.append(len(long))
        long += one
    texts = [" ".join(long), *(" ".join(_passage(rnd, 40) + two + _passage(rnd, 40)) for _, two in pairs)]
    out = substring_dedup.repeated_passages(frame(spark, texts)).orderBy("doc_id").collect()
    assert len({r["component_id"] for r in out}) == 1
    assert [len(r["spans"]) for r in out] == [4, 1, 1, 1, 1]


def test_rows_of_pairs_are_compared_as_single_pairs():
    rng = np.random.default_rng(27)
    a, at, b, bt = [], [], [], []
    for k in range(400):
        high = (2, 6, 40, 1 << 60)[k % 4]
        n, m = rng.integers(46, 92, 2)
        one, two = rng.integers(0, high, n, dtype=np.uint64), rng.integers(0, high, m, dtype=np.uint64)
        i, j = int(rng.integers(max(0, n - 46), min(n, 46))), int(rng.integers(max(0, m - 46), min(m, 46)))
        before, after = min(i, j), min(n - i, m - j)
        two[j - before:j + after] = one[i - before:i + after]
        x = int(rng.integers(0, m))
        two[x:x + int(rng.integers(0, 7))] = rng.integers(0, high)
        two[j] = one[i]
        for rows, row in ((a, one), (at, i), (b, two), (bt, j)):
            rows.append(row)
    got = substring_dedup.similar_rows(a, np.array(at), b, np.array(bt))
    want = [substring_dedup.similar(*pair) or (-1, -1) for pair in zip(a, at, b, bt)]
    assert [tuple(r) for r in got.tolist()] == want
    assert 40 < sum(w[0] >= 0 for w in want) < 400


def test_sub_keys_of_repeated_words_lose_no_similar_pair():
    """Near-duplicates that agree on a minimum that is one of the key's
    shingles again agree on what stands in its place."""
    rng = np.random.default_rng(28)
    side, lost, met, apart = substring_dedup.SIDE, 0, 0, 0
    for k in range(1500):
        period = rng.integers(0, 1 << 60, int(rng.integers(1, 4)), dtype=np.uint64)
        a = np.tile(period, 91)[:91]
        for _ in range(int(rng.integers(0, 4))):
            x = int(rng.integers(0, 91))
            a[x:x + int(rng.integers(1, 12))] = rng.integers(0, 1 << 60, dtype=np.uint64)
        b, x = a.copy(), int(rng.integers(0, 91))
        b[x:] = np.roll(b[x:], int(rng.integers(0, 3)))
        b[int(rng.integers(0, 91)):][:1 + k % 40] = rng.integers(0, 1 << 60, dtype=np.uint64)
        back = k % 2
        own = slice(45 - side * back, 45 - side * back + side + 1)
        a[own] = b[own] = np.tile(period, 9)[:side + 1]
        old, new = [], []
        for s in (a, b):
            args = s, np.array([45]), np.array([0]), np.array([11])
            old.append(set(substring_dedup._sub_keys(*args)[0].tolist()))
            subs, sizes = substring_dedup._sub_keys(*args, np.array([back]))
            assert sizes.tolist() == [len(subs)] == [len(set(subs.tolist()))]
            new.append(set(subs.tolist()))
        if old[0] & old[1]:
            if substring_dedup.similar(a, 45, b, 45):
                met, lost = met + 1, lost + (not new[0] & new[1])
            else:
                apart += not new[0] & new[1]
    assert not lost and met > 300 and apart > 50, (lost, met, apart)


def test_a_word_repeated_in_unlike_texts_brings_no_pairs(spark, monkeypatch):
    """All share the run of one word, no two a passage; nothing is compared."""
    rnd = random.Random(29)
    word = min(_passage(rnd, 3000), key=lambda w: substring_dedup._mix(
        substring_dedup.shingle_hashes([w.encode()] * 5) + substring_dedup._seed(1))[0])
    texts = [" ".join(_passage(rnd, 60) + [word] * 30 + _passage(rnd, 60)) for _ in range(8)]
    pairs, near = [], substring_dedup._near

    def counted(p, *rest):
        pairs.append(p.count())
        return near(p, *rest)
    monkeypatch.setattr(substring_dedup, "_near", counted)
    out = substring_dedup.repeated_passages(frame(spark, texts)).collect()
    assert all(r["component_id"] == r["doc_id"] and not r["spans"] for r in out)
    assert sum(pairs) == 0


def test_words_shingles_and_windows_by_arrays_are_those_of_single_texts():
    rnd = random.Random(31)
    marks = "".join(chr(b) for b in range(33, 127) if not chr(b).isalnum())
    texts = [None, "", " \t\n ", "--- a,b, ...c... 'Hello' \u00e9\u00c9!", "-" * 100 + " x" + "!" * 50 + " " + "!" * 50 + "y", "The " * 300 + "end",
             *(" ".join("".join(rnd.choice("aB\u00e9" + marks) for _ in range(rnd.randint(1, 40))) for _ in range(n)) for n in range(0, 200, 7))]
    batch = pa.record_batch([pa.array(texts), pa.array(range(len(texts)))], ["text", "n"])
    seen = 0
    for rows, x in shingles.parts(iter([batch, batch.slice(3, 5)])):
        points = x.code_points()
        for k, n in enumerate(rows.column(1).to_pylist()):
            words = substring_dedup.plain_words(texts[n])
            s = substring_dedup.shingle_hashes(words)
            assert x.n_words[k] == len(words) and x.s[x.lo[k]:x.hi[k]].tolist() == s.tolist()
            at = slice(x.word[k], x.word[k + 1])
            bounds = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", texts[n] or "")]
            assert list(zip((points[x.first[at]] - points[x.off[k]]).tolist(), (points[x.last[at]] - points[x.off[k]]).tolist())) == bounds
            seen += 1
    assert seen == len(texts) + 5


def _near_counted(s, groups, own, comp):
    """Links and number of comparisons of surroundings in groups of all."""
    n = len(s)
    rows, compared = substring_dedup._Rows(s, np.zeros(n, np.int64), np.full(n, 91)), []
    alike = rows.alike

    def counted(a, b):
        compared.extend(zip(a.tolist(), b.tolist()))
        return alike(a, b)
    rows.alike = counted
    found = [(a, b) for u, v, _, _ in substring_dedup._near_rows(
        rows, np.repeat(np.arange(groups), n), np.tile(np.arange(n), groups), own, np.ones(n, bool), comp) for a, b in zip(u, v)]
    assert len(compared) == len(set(compared))
    return found, len(compared)


def test_comparisons_of_a_large_group_do_not_grow_with_its_square():
    """600 surroundings of 20 unlike kinds, those of a kind alike, their texts
    linked: each is compared until it has a match."""
    rng = np.random.default_rng(32)
    kind = rng.integers(0, 1 << 47, (20, 91)).astype(np.uint64)
    kind[:, 37:54] = kind[0, 37:54]
    s = np.repeat(kind, 30, axis=0)
    s[np.arange(600), rng.choice([10, 20, 70, 80], 600)] = rng.integers(0, 1 << 47, 600).astype(np.uint64)
    order = rng.permutation(600)
    found, compared = _near_counted(s[order], 2, order, np.zeros(600, np.int64))
    assert {i for p in found for i in p} == set(range(600)) and all(order[a] // 30 == order[b] // 30 for a, b in found)
    assert compared < 600 * 50, compared  # of 179,700 pairs


def test_every_pair_that_matters_of_a_group_is_compared():
    """Only pairs are alike, whichever is a pivot first; two are of one text."""
    rng = np.random.default_rng(33)
    s = np.repeat(rng.integers(0, 1 << 47, (40, 91)).astype(np.uint64), 2, axis=0)
    s[:, 37:54] = s[0, 37:54]
    s[::2, 30] = rng.integers(0, 1 << 47, 40).astype(np.uint64)
    order = rng.permutation(80)
    own = order // 2 * 2 + (order % 2) * (order > 3)  # the first two pairs are of one text each
    found, _ = _near_counted(s[order], 1, own, np.arange(80))
    want = {frozenset((2 * i, 2 * i + 1)) for i in range(2, 40)}
    assert {frozenset(order[list(p)].tolist()) for p in found} == want


def test_surroundings_too_many_for_a_task_give_the_same(spark, monkeypatch):
    rnd = random.Random(34)
    footer = _passage(rnd, 60)
    texts = [" ".join(_passage(rnd, 70) + p + _passage(rnd, 70) + footer) for pair in _around_a_phrase(rnd, 4) for p in pair]
    out = substring_dedup.repeated_passages(frame(spark, texts)).orderBy("doc_id").collect()
    calls, near = [], substring_dedup._near

    def counted(p, *rest):
        calls.append(p.count())
        return near(p, *rest)
    monkeypatch.setattr(substring_dedup, "_near", counted)
    monkeypatch.setattr(substring_dedup, "_LARGE", 2)
    again = substring_dedup.repeated_passages(frame(spark, texts)).orderBy("doc_id").collect()
    assert sum(calls) > 0
    assert [r["component_id"] for r in again] == [r["component_id"] for r in out] == [0] * len(texts)
    for a, b in zip(again, out):
        assert len(a["spans"]) == len(b["spans"]) > 0


def test_repeated_passages_awkward_rows(spark):
    df = awkward(spark)
    out = substring_dedup.repeated_passages(df).collect()
    assert len(out) == df.count()
    assert all(r["component_id"] == r["doc_id"] for r in out)
    assert substring_dedup.repeated_passages(df.limit(0)).count() == 0


def test_mixing_meets_targets_and_is_optimal(spark):
    rnd = random.Random(8)
    texts = [" ".join("w" * rnd.randint(1, 120)) for _ in range(400)] + [None, "", " "]
    source = [rnd.choice(["a", "b", "c", "d", None]) if i > 100 else "a" for i in range(len(texts))]
    df = frame(spark, texts, source=source)
    out = mixing.mix(df).collect()
    assert len(out) == len(texts)
    size = {r["doc_id"]: r["size"] for r in out}
    assert all(size[i] == len((t or "").split()) for i, t in enumerate(texts))
    names = ["a", "b", "c", "d", None]
    total = {s: sum(size[i] for i in size if source[i] == s) for s in names}
    weight, fixed = dict(zip(names, [3, 1, 2, 3, 1])), {}
    while True:  # targets by hand: share out, stop at twice the size, share again
        rest = 1.5 * sum(total.values()) - sum(fixed.values())
        free = [s for s in names if s not in fixed]
        goal = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if goal[s] > 2 * total[s]]
        if not above:
            break
        fixed |= {s: 2.0 * total[s] for s in above}
    goal |= fixed
    for s in names:
        rows = [r for r in out if source[r["doc_id"]] == s]
        assert rows[0]["target"] == pytest.approx(goal[s]) and rows[0]["source_size"] == total[s]
        assert abs(sum(r["taken"] for r in rows) - goal[s]) <= 60
        # the rates are one exponential tilt, stopped at two, and meet the target exactly
        assert sum(r["rate"] * r["size"] for r in rows) == pytest.approx(goal[s], rel=1e-5)
        tilt = [math.log(r["rate"]) / r["size"] for r in rows if r["size"] and r["rate"] < 2 - 1e-9]
        assert not tilt or max(tilt) - min(tilt) < 1e-6
    assert all(0 <= r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"] for r in out)
    assert sorted(map(tuple, mixing.mix(df).collect())) == sorted(map(tuple, out))


def test_mixing_awkward_rows(spark):
    df = awkward(spark)
    out = mixing.mix(df).collect()
    assert len(out) == df.count() and all(r["size"] == 0 or r["taken"] <= 2 * r["size"] for r in out)
    assert mixing.mix(df.limit(0)).count() == 0
    blank = mixing.mix(frame(spark, ["", None, " "])).collect()
    assert [(r["taken"], r["target"], r["copies"]) for r in blank] == [(0, 0.0, 1)] * 3


_ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def _known_secrets(t):
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(t) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16])


def test_known_secrets_equal_brute_force(spark):
    rnd = random.Random(10)
    parts = ["token", "PassWord", "api_key", "apikey", "secret", "=", ": ", '"', "'", " ", "\n", "é\U0001f600", "AKIA", "ABCDEF0123456789",
             "0123456789abcdef", "abcdefghijkl", "x", "token=short", "password: token = abcdefghijklmnop"]
    texts = [None, ""] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 12))) for _ in range(300)]
    for r in secret_scan.scan_secrets(frame(spark, texts)).collect():
        known = [(s["start"], s["kind"], s["end"]) for s in r["found"] if s["kind"] < 3]
        assert known == _known_secrets(texts[r["doc_id"]] or ""), texts[r["doc_id"]]


def test_random_tokens_are_told_from_text(spark):
    rnd = random.Random(11)
    base62 = string.ascii_letters + string.digits
    words = ["in", "the", "tion", "er", "an", "ou", "st"]

    def prose():
        return " ".join("".join(rnd.choice(words) for _ in range(rnd.randint(3, 12))) for _ in range(40))
    planted = {0: lambda: "".join(rnd.choice(base62) for _ in range(40)), 1: lambda: "".join(rnd.choice(base62 + "+/") for _ in range(64)),
               2: lambda: base62, 3: lambda: "some/long/path-name/with-words/and-more/index", 4: lambda: "a" * 20 + "Bb" * 12,
               5: lambda: "2024" * 10 + "z", 6: lambda: "".join(rnd.choice("0123456789ABCDEF") for _ in range(48))}
    rows = [(i % 8, prose() + " " + planted.get(i % 8, lambda: "")() + " " + prose()) for i in range(160)]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    hit = {k: 0 for k in range(8)}
    for r in secret_scan.scan_secrets(df).collect():
        hit[r["doc_id"] % 8] += any(s["kind"] == 3 for s in r["found"])
    assert min(hit[0], hit[1], hit[6]) >= 19 and max(hit[2], hit[3], hit[4], hit[5], hit[7]) == 0


def test_a_token_of_boilerplate_counts_once(spark):
    rnd = random.Random(23)
    keys = ["".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(32)) for _ in range(40)]
    texts = [f"see {k} here" for k in keys] + ["see some/long/path-name/with-words/xyz here"] * 4000
    found = {r["doc_id"] for r in secret_scan.scan_secrets(frame(spark, texts)).collect() if r["found"]}
    assert len(found) >= 20 and max(found) < 40


def test_secrets_awkward_rows(spark):
    df = awkward(spark)
    out = secret_scan.scan_secrets(df).collect()
    assert len(out) == df.count() and all(r["found"] == [] for r in out)
    assert secret_scan.scan_secrets(df.limit(0)).count() == 0


_EMAIL, _IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD, _PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _known_personal(t):
    out = [(m.start(), 0, m.end()) for m in _EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, rx, lo, hi in ((2, _CARD, 14, 19), (3, _PHONE, 10, 15)):
        for m in rx.finditer(t):
            d = re.sub("[^0-9]", "", m[0])
            if lo <= len(d) <= hi and (kind == 3 or pii.luhn(d)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_known_personal_data_equals_brute_force():
    rnd = random.Random(12)
    parts = ["a@b.co", "1.2.3.4", "@", ".", "+1", " ", "-", "9", "4111 1111 1111 1111", "(", ")", "5551234567", "é", "%", "300.1.1.1", "000.0255.1.2",
             "+1 (743) 555-3824", "\n"]
    for _ in range(8000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 9)))
        assert pii.base_spans(t) == _known_personal(t), t


def _sample(rnd, n=300):
    out = []
    for _ in range(n):
        d = "".join(rnd.choice("0123456789") for _ in range(15))
        card = next(d + c for c in "0123456789" if pii.luhn(d + c))
        phone = f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(0, 9999):04}"
        what = rnd.choice((card, phone, f"jo.{rnd.randint(0, 99)}@mail{rnd.randint(0, 9)}.example.com", ".".join(str(rnd.randint(0, 255)) for _ in range(4)),
                           str(rnd.randint(1000, 10**9))))
        t = f"some words {what} and more"
        out.append((t, pii.base_spans(t)))
    return out


def test_field_adds_what_the_patterns_miss_and_no_plain_numbers():
    field = pii.train(_sample(random.Random(13)))
    for t, kind in (("call (212) 555-0199 now", 3), ("at 212-555-0199 now", 3), ("card 4111.1111.1111.1111 ok", 2)):
        got = pii.decode(field, t, pii.base_spans(t), 0.8)
        assert [k for _, k, _, _ in got] == [kind], (t, got)
    for t in ("on 2024-01-02 12:30 we", "number 4111 1111 1111 1112 no", "id 1234567890123456 x", "version 1.2.3 of it", "years 1990-1995 or"):
        assert pii.decode(field, t, pii.base_spans(t), 0.8) == [], t


def _random_field(seed, text):
    rng = np.random.default_rng(seed)
    field = pii.Field(rng.normal(0, 1, (pii.FEATURES, len(pii.KINDS))), rng.normal(0, 1, (pii.LABELS, pii.LABELS)))
    tok = pii.tokens(text)
    return field, tok, pii.Lattice(len(tok), pii.segments(text, tok), field.w, keep=True)


def _labellings(field, lat):
    """(score, entities, transitions) of every labelling."""
    def paths(at, last):
        if at == lat.n:
            yield 0.0, (), np.zeros((pii.LABELS, pii.LABELS))
            return
        for k, j, y in [(None, at + 1, 0)] + [(k, lat.end[k], y) for k in range(len(lat)) if lat.begin[k] == at for y in range(1, pii.LABELS)]:
            for s, p, t in paths(j, y):
                t = t.copy()
                t[last, y] += 1
                own = 0.0 if k is None else lat.score[k * len(pii.KINDS) + y - 1]
                yield s + field.trans[last, y] + own, p if k is None else ((k, y - 1), *p), t
    return list(paths(0, 0))


def test_field_sums_agree_with_enumeration():
    """Forward-backward against all labellings of a short region."""
    field, tok, lat = _random_field(14, "x 1234 5678 y")
    every = _labellings(field, lat)
    z = sum(math.exp(s) for s, *_ in every)
    want, pairs = np.zeros((len(lat), len(pii.KINDS))), 0
    for s, p, t in every:
        pairs = pairs + t * math.exp(s) / z
        for k, y in p:
            want[k, y] += math.exp(s) / z
    post, expected, log_z = field.posteriors(lat)
    assert np.allclose([post[k] for k in range(len(lat))], want)
    assert np.allclose(expected, pairs) and log_z == pytest.approx(math.log(z))
    best = max(every, key=lambda x: x[0])
    assert tuple(field.best(lat)) == best[1]
    assert np.allclose(pii.gold_pairs(lat, list(best[1])), best[2])
    assert field.log_likelihood(lat, list(best[1])) == pytest.approx(best[0] - math.log(z))


def test_gradient_agrees_with_finite_differences():
    text = "tel 555-1234 and 12.34.56.78 or a.b@c.de 1234 567"
    field, tok, lat = _random_field(15, text)
    gold = [(k, y) for k, y in field.best(lat)][:2]
    rows, pairs = pii.gradient(field, lat, gold)

    def likelihood():
        return field.log_likelihood(pii.Lattice(lat.n, pii.segments(text, tok), field.w), gold)
    step = 1e-5
    for x in range(pii.LABELS):  # all 25 transitions
        for y in range(pii.LABELS):
            field.trans[x, y] += step
            up = likelihood()
            field.trans[x, y] -= 2 * step
            assert (up - likelihood()) / (2 * step) == pytest.approx(pairs[x, y], abs=1e-3), (x, y)
            field.trans[x, y] += step
    total = np.zeros_like(field.w)
    for f, g in rows:
        for k in f:
            total[k] += g
    for k in sorted({k for f in lat.features for k in f}):
        for y in range(len(pii.KINDS)):
            field.w[k, y] += step
            up = likelihood()
            field.w[k, y] -= 2 * step
            assert (up - likelihood()) / (2 * step) == pytest.approx(total[k, y], abs=2e-3), (k, y)
            field.w[k, y] += step


def test_recall_and_precision_on_generated_formats():
    """Formats the patterns miss, in texts apart from the training ones; and numbers that name nobody."""
    field = pii.train(_sample(random.Random(21)))
    rnd = random.Random(22)
    before, after = ["reach us at", "my number", "call", "please dial", "card", "pay with", "it says"], ["today", "or so", "thanks", "and then", "please"]
    found = wanted = wrong = 0
    for _ in range(400):
        d = "".join(rnd.choice("0123456789") for _ in range(15))
        card = next(d + c for c in "0123456789" if pii.luhn(d + c))
        n = (rnd.randint(200, 999), rnd.randint(200, 999), f"{rnd.randint(0, 9999):04}")
        what = rnd.choice(["({}) {}-{}".format(*n), "{}-{}-{}".format(*n), "{}.{}.{}".format(*n), "-".join(card[i:i + 4] for i in range(0, 16, 4)),
                           ".".join(card[i:i + 4] for i in range(0, 16, 4)), " ".join(card[i:i + 4] for i in range(0, 16, 4))])
        kind = 2 if len(what) > 15 else 3
        t = f"{rnd.choice(before)} {what} {rnd.choice(after)}"
        base = pii.base_spans(t)
        if base:
            continue
        wanted += 1
        at = t.index(what)
        got = pii.decode(field, t, base, 0.8)
        found += any((a, k, b) == (at, kind, at + len(what)) for a, k, b, _ in got)
        wrong += sum((a, k, b) != (at, kind, at + len(what)) for a, k, b, _ in got)
    plain = 0
    for _ in range(400):
        t = f"{rnd.choice(before)} {pii._plain_number(rnd)} {rnd.choice(after)}"
        plain += bool(pii.decode(field, t, pii.base_spans(t), 0.8)) and not pii.base_spans(t)
    print(f"recall {found}/{wanted}, other spans {wrong}, plain numbers marked {plain}/400")
    assert found >= 0.9 * wanted and wrong <= 0.05 * wanted and plain <= 0.03 * 400


def test_a_long_text_of_numbers_is_linear():
    field = pii.train(_sample(random.Random(23), 60), epochs=1)
    rnd = random.Random(24)

    def seconds(n):
        text = " ".join(str(rnd.randint(1000, 999_999)) for _ in range(n)) + " call (212) 555-0199"
        start = __import__("time").process_time()
        spans = pii.decode(field, text, pii.base_spans(text), 0.8)
        return __import__("time").process_time() - start, spans
    short, long = seconds(5_000)[0], seconds(40_000)[0]
    print(f"5,000 numbers {short:.2f} s, 40,000 numbers {long:.2f} s")
    assert long < 16 * short + 2


def test_personal_data_awkward_rows(spark):
    df = awkward(spark)
    out = pii.find_personal_data(df).collect()
    assert len(out) == df.count() and all(r["base"] == [] and r["added"] == [] for r in out)
    assert pii.find_personal_data(df.limit(0)).count() == 0
    texts = ["mail a@b.co", None, "4111 1111 1111 1111 and +1 (743) 555-3824", "1" * 200_000, "1." * 50_000, "@" * 1000]
    for r in pii.find_personal_data(frame(spark, texts)).collect():
        assert [tuple(s) for s in map(lambda s: (s["start"], s["kind"], s["end"]), r["base"])] == _known_personal(texts[r["doc_id"]] or "")


def test_index_classes_guarantee_recall():
    ix = licenses.Index(list(licenses.TEMPLATES), 0.8, 0.999)
    for width, stride, bands, members in ix.classes:
        for m in members:
            n = len(ix.sets[m])
            assert width >= math.ceil(n / 0.8) + stride - 1
            least = 0.8 * n / (width + 0.2 * n)
            assert 1 - (1 - least ** licenses.ROWS) ** bands >= 0.999


@pytest.mark.parametrize("max_bits, segments", [(0, 32), (1, 16), (2, 32), (2, 8), (3, 16), (4, 32)])
def test_range_join_loses_no_neighbour(spark, max_bits, segments):
    """All fingerprints with another one within max_bits pass; most others do not."""
    rnd = random.Random(max_bits * 100 + segments)
    fps = [rnd.getrandbits(64) for _ in range(300)]
    for v in fps[:60]:
        for bits in range(1, 6):
            fps.append(v ^ sum(1 << b for b in rnd.sample(range(64), bits)))
    fps += [0, (1 << 64) - 1, 1, 1 << 63, (1 << 63) | 1]
    fps = sorted({v - (1 << 64) if v >> 63 else v for v in fps})
    got = {r["fp"] for r in simhash.in_company(spark.createDataFrame([(v,) for v in fps], "fp long"), max_bits, segments).collect()}
    mask = (1 << 64) - 1

    def vector(v):
        w = 64 // segments
        return [((v & mask) >> (w * k) & ((1 << w) - 1)).bit_count() for k in range(segments)]
    vectors = {v: vector(v) for v in fps}
    reach = max_bits + max_bits % 2
    want = {v for v in fps if any(u != v and sum(abs(a - b) for a, b in zip(vectors[u], vectors[v])) <= reach for u in fps)}
    assert got == want
    assert {v for v in fps if any(u != v and ((u ^ v) & mask).bit_count() <= max_bits for u in fps)} <= got
    if segments == 32 and max_bits <= 2:
        assert len(got) < len(fps)
