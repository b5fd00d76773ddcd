"""Line dedup, decontamination, language ID, quality rules and licenses
against brute force, planted cases and awkward rows."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import awkward, frame, hits, line_dedup, repeated_windows
from postlake.llm import decontaminate, langid, licenses, quality
from postlake.llm.line_dedup import dedup_lines

COMMON = "A line that many of the documents share"


def test_line_dedup_equals_brute_force(spark):
    rnd = random.Random(1)
    pool = [COMMON, "  " + COMMON.upper() + "\t", "short line", "É" * 25, "é" * 25, "x" * 20, "x" * 19, "", " ", "only here " * 3]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 8)))) for i in range(40)] + [(40, None), (41, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in dedup_lines(df).collect())
    assert got == sorted(line_dedup(rows))


def test_line_dedup_awkward_rows(spark):
    df = awkward(spark)
    out = dedup_lines(df, min_chars=5, min_docs=2, carry=True).collect()
    assert len(out) == df.count()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
        assert r["doc"]["kept_text"] == "clash"
    # ids 5 and 6 hold the line: it stays in 6, goes in both rows of 5
    assert [r["n_dropped"] for r in by[5]] == [1, 1]
    assert sorted(r["kept_text"] for r in by[6]) == ["another text under the same id", "same text here for ties"]
    assert by[1][0]["kept_text"] == "" and by[1][0]["n_lines"] == 1
    assert dedup_lines(df.limit(0)).count() == 0


def _items():
    words = [f"w{i}" for i in range(60)]
    return [(1, " ".join(words[:30])), (2, "Short, item!"), (3, None), (4, "... ---"), (5, " ".join(words[20:32])),
            (None, "nobody owns these four words"), (1, " ".join(words[:30]))]


def test_decontamination_equals_brute_force(spark):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(34)]
    texts = [None, "", "SHORT item", "short; Item? and é", "nobody owns these four words"]
    for _ in range(30):
        a = rnd.randrange(30)
        texts.append(" ".join(rnd.choice(words) for _ in range(5)) + " - " + ", ".join(words[a:a + rnd.randint(3, 20)]).upper()
                     + " x " + " ".join(words[:rnd.randint(0, 14)]))
    items = _items()
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = frame(spark, texts)
    for block in (1 << 20, 40):  # one automaton, and several
        out = {r["doc_id"]: r for r in decontaminate.mark_contaminated(df, bench, block_bytes=block).collect()}
        for i, t in enumerate(texts):
            assert (out[i]["n_words"], out[i]["n_hit"], out[i]["items"]) == hits(t, items), t
            covered = "".join(t[s["start"]:s["end"]] for s in out[i]["char_spans"])
            assert len(decontaminate.normal_words(covered)) <= out[i]["n_hit"]
            assert sum(s["end"] - s["start"] for s in out[i]["word_spans"]) == out[i]["n_hit"]


def test_decontamination_awkward_rows(spark):
    df, none = awkward(spark), spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.mark_contaminated(df, none)
    assert out.count() == df.count() and out.where("n_hit > 0").count() == 0
    assert "items" in out.columns and out.schema["items"].dataType.simpleString() == "array<string>"
    bench = spark.createDataFrame([(1, "very long text with")], "item_id long, text string")
    assert decontaminate.mark_contaminated(df, bench).where("n_hit = 80000").count() == 1
    assert decontaminate.mark_contaminated(df.limit(0), bench).count() == 0


def test_language_id_held_out_accuracy(spark, sf_small):
    docs = spark.read.parquet(sf_small + "/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), per_class=100)
    out = langid.predict(docs, model).where(langid.held_out(F.col("doc_id")))
    right, n = out.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right / n >= 0.95
    assert 0 < (model.weights != 0).mean() < 0.5  # the L1 penalty leaves most weights at zero
    again = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), per_class=100)
    assert (again.weights == model.weights).all() and again.temperature == model.temperature


def test_language_id_awkward_rows(spark):
    df = awkward(spark)
    model = langid.fit(df, per_class=5)
    assert model.classes == ("de", "en", "fr")
    out = langid.predict(df, model).collect()
    assert len(out) == df.count()
    for r in out:
        lettered = r["text"] and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == (not lettered) and 0.0 <= r["score"] <= 1.0
    nothing = langid.fit(df.limit(0))
    assert nothing.classes == ()
    assert {tuple(r) for r in langid.predict(df, nothing).select("lang_pred", "score").collect()} == {("und", 0.0)}
    assert langid.predict(df, model, min_score=0.0).where("lang_pred = 'und'").count() == 0


def test_gram_counts_do_not_depend_on_chunks(monkeypatch):
    text = "Größe, naïve 123 \U0001f600 " * 50
    whole = langid.gram_counts(text, 12)
    monkeypatch.setattr(langid, "CHUNK", 97)
    parts = langid.gram_counts(text, 12)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()
    monkeypatch.setattr(langid, "CHUNK", 1)
    assert whole[1].tolist() == langid.gram_counts(text, 12)[1].tolist()


def test_temperature_minimises_the_cross_entropy():
    rng = np.random.default_rng(1)
    z, labels = rng.normal(size=(200, 4)) * 6, rng.integers(0, 4, 200)
    z[np.arange(200), labels] += 3
    sums = sum(langid._calibration_sums(row, k) for row, k in zip(z, labels))
    want = np.full((200, 4), 1 / 204)
    want[np.arange(200), labels] += 200 / 204

    def loss(t):
        s = z / t
        return float((np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - (want * s).sum(1)).sum())
    best = langid._temperature(sums, 4)
    assert loss(best) <= min(map(loss, np.geomspace(0.05, 20, 3000))) + 1e-3
    assert langid._temperature(sums * 0, 4) == 1.0


def test_repeated_rows_do_not_certify(spark):
    """40 labelled documents repeated 60 times are 40 documents."""
    rows = []
    for i in range(80):
        words = " ".join(f"w{i}x{j}" + ("#*" if i % 2 else "") for j in range(60))
        rows += [(i, words, "en")] * 60
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(80)], "doc_id long, quality int")
    assert quality.judge(df, labels, risk=0.02).where("not kept").count() == 0


def test_a_benchmark_text_with_many_ids_is_dealt_over_the_blocks(spark):
    text = " ".join(f"w{i}" for i in range(12))
    bench = spark.createDataFrame([(i, text) for i in range(300)] * 2, "item_id long, text string")
    df = frame(spark, [text, "else " + text + " where", "nothing"])
    one, many = (decontaminate.mark_contaminated(df, bench, block_bytes=b).orderBy("doc_id").collect() for b in (1 << 20, 2000))
    assert one == many and len(one[0]["items"]) == 300 and one[2]["n_hit"] == 0


def test_quality_statistics_equal_brute_force(spark):
    rnd = random.Random(3)
    texts = [None, "", " ", "a b", "a b c", "a b c a b c", "#*$ %&|<> é\x0b\x0c x"]
    texts += [" ".join(rnd.choice("abcdeÉ#") for _ in range(rnd.randint(1, 60))).replace("e a", "e\na") for _ in range(60)]
    for r in quality.statistics(frame(spark, texts)).collect():
        t = r["text"] or ""
        lines, seen, dup = t.split("\n"), set(), 0
        for x in lines:
            if x.strip(" \t\n\x0b\x0c\r"):
                dup += x in seen
                seen.add(x)
        words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", t)]
        assert (r["n_words"], r["n_repeat_words"]) == (len(words), repeated_windows(t))
        if words:
            assert r["word_chars"] == sum(map(len, words)) and r["n_dup_lines"] == dup
            assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in t)


def test_binomial_tail_is_exact():
    from math import comb
    for n, k, p in ((10, 3, 0.2), (200, 0, 0.01), (60, 59, 0.5), (500, 12, 0.02)):
        want = sum(comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1))
        assert quality.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9)
    for n, p in ((50, 0.3), (40, 0.9)):
        for k in range(n + 1):
            want = sum(comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1))
            assert quality.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9, abs=1e-12)
    # far above and at the mean of a large sample it stops early
    assert quality.binomial_tail(5 * 10**8, 10**9, 0.02) == 1.0
    assert quality.binomial_tail(2 * 10**5, 10**7, 0.02) == pytest.approx(0.5, abs=0.01)


def test_quality_rules_control_false_rejection(spark):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(3000):
        bad = i % 5 == 0
        w = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(60)]
        rows.append((i, " ".join(x + ("#*" if bad else "") for x in w), "en" if i % 2 else "fr"))
        if i < 2400:
            labels.append((i, 0 if bad else 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = quality.judge(df, spark.createDataFrame(labels, "doc_id long, quality int"), risk=0.05)
    got = {r["doc_id"]: r["kept"] for r in out.collect()}
    assert all(got[i] == (i % 5 > 0) for i in range(3000))
    # without labels, or with too few to certify anything, only the base rules decide
    for lab in (labels[:0], labels[:50]):
        out = quality.judge(df, spark.createDataFrame(lab, "doc_id long, quality int"))
        assert out.where("kept").count() == 3000


def test_quality_awkward_rows(spark):
    df = awkward(spark)
    labels = spark.createDataFrame([(5, 1), (5, 0), (None, 1), (6, None), (4, 1)], "doc_id long, quality int")
    out = quality.judge(df, labels).collect()
    assert len(out) == df.count()
    assert all(r["base_failed"] and not r["kept"] for r in out)
    assert quality.judge(df.limit(0), labels).count() == 0


def test_licenses_in_noise_are_found(spark):
    rnd = random.Random(5)
    noise = [" ".join(rnd.choice("alpha beta gamma delta the license under".split()) for _ in range(80)) for _ in range(30)]
    texts = [n + " " + licenses.TEMPLATES[i % len(licenses.TEMPLATES)][1].upper() + "\n" + n for i, n in enumerate(noise)]
    out = licenses.find_licenses(frame(spark, texts + noise)).collect()
    for r in out:
        i = r["doc_id"]
        if i < 30:
            name, text = licenses.TEMPLATES[i % len(licenses.TEMPLATES)]
            assert r["licenses"] == [name]
            m = r["matches"][0]
            assert decontaminate.normal_words(texts[i][m["start"]:m["end"]]) == decontaminate.normal_words(text)
        else:
            assert r["licenses"] == []


def test_license_containment_is_exact(spark):
    own = [("T", " ".join(f"t{i}" for i in range(24)))]  # 20 shingles
    words = own[0][1].split()
    for cut, found in ((20, True), (19, False)):  # 16 and 15 of 20 shingles
        got = licenses.scan(" ".join(["x"] * 40 + words[:cut] + ["y"] * 40), licenses.Index(own, 0.8, 0.999), 0.8)
        assert bool(got) == found
    with pytest.raises(ValueError):
        licenses.Index([("T", "too short")], 0.8, 0.99)
    assert licenses.find_licenses(frame(spark, ["a b c d e f"]), templates=[]).first()["matches"] == []


def _contained(text, templates, containment, max_gap):
    """Names of templates that some stretch of the text contains, tried for every stretch of words."""
    words, out = licenses.normal_words(text), set()
    every = {s for _, t in templates for s in licenses.shingles(licenses.normal_words(t))}
    places = [i for i, s in enumerate(licenses.shingles(words)) if s in every]
    breaks = [0] + [k + 1 for k, (a, b) in enumerate(zip(places, places[1:])) if b - a - licenses.SHINGLE > max_gap] + [len(places)]
    all_shingles = licenses.shingles(words)
    for lo, hi in zip(breaks, breaks[1:]):
        have = {all_shingles[p] for p in places[lo:hi]}
        for name, t in templates:
            own = set(licenses.shingles(licenses.normal_words(t)))
            if len(own & have) >= containment * len(own):
                out.add(name)
    return out


def test_changed_notices_against_brute_force():
    """Words deleted, replaced and put in (also many in one place): all with 0.8 of a template's shingles are
    found, and the most specific notice is named."""
    rnd = random.Random(31)
    index = licenses.Index(list(licenses.TEMPLATES), 0.8, 0.999)
    full = [(n, t) for n, t in licenses.TEMPLATES if len(t.split()) > 25]
    found = wanted = named = 0
    for _ in range(400):
        name, text = rnd.choice(full)
        words = text.split()
        for _ in range(rnd.randint(0, 2)):
            k = rnd.randrange(len(words))
            words[k:k + rnd.randint(0, 1)] = [f"foreign{rnd.randint(0, 99)}"] * rnd.choice((0, 1, 3, 60, 150))
        t = " ".join([f"x{rnd.randint(0, 99)}" for _ in range(30)] + words + [f"y{rnd.randint(0, 99)}" for _ in range(30)])
        have = _contained(t, licenses.TEMPLATES, 0.8, 200)
        got = licenses.scan(t, index, 0.8)
        assert {g[0] for g in got} <= have
        if name in have:
            wanted += 1
            found += bool(got)
            named += any(g[0] == name for g in got)
    print(f"{wanted} notices with 0.8 of their shingles, {found} found, {named} by their own name")
    assert wanted > 200 and found >= 0.99 * wanted and named >= 0.95 * wanted


@pytest.mark.parametrize("name", sorted({n for n, _ in licenses.TEMPLATES}))
def test_whole_notices_have_their_own_name(name):
    index = licenses.Index(list(licenses.TEMPLATES), 0.8, 0.999)
    for n, text in licenses.TEMPLATES:
        if n == name:
            assert [g[0] for g in licenses.scan("before it " + text.lower() + " after it", index, 0.8)] == [name]


def test_long_insertions_and_distant_halves():
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 100).split()
    index = licenses.Index(list(licenses.TEMPLATES), 0.8, 0.999)
    for gap, n in ((45, 1), (60, 1), (190, 1), (400, 0)):
        t = " ".join(mit[:30] + ["other"] * gap + mit[30:])
        assert len(licenses.scan(t, index, 0.8)) == n, gap


def test_licenses_awkward_rows(spark):
    df = awkward(spark)
    out = licenses.find_licenses(df)
    assert out.count() == df.count() and Counter(len(r["matches"]) for r in out.collect()) == {0: df.count()}
    assert licenses.find_licenses(df.limit(0)).count() == 0


