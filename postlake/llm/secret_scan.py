"""Secret scan: known shapes, and random-looking tokens by a test battery.

Known shapes (assignments to a password-like name, access keys, long hex runs)
are found by regular expressions.  Other tokens of 20 characters or more pass
two filters, which together keep what looks random and cannot well be text:

* a randomness battery, per inferred encoding (hex, base32, base62, base64 or
  its URL form): chi-squared uniformity over the encoding's alphabet, a runs
  test of its lower against its upper half, and the lag-one serial
  correlation of the symbols.  A token that one of the three rejects
  (Bonferroni at ``battery_level``) is no secret;
* false-discovery control against ordinary text.  Under that null the
  p-value is bounded by how few symbols coincide (text repeats its letters,
  Poisson tail bound) or, for hex, by how unlikely text keeps to a-f.  Both
  bounds sharpen with length.  Benjamini-Hochberg runs over all distinct tokens
  of the corpus within each length band, so short tokens, which are many, pay
  for their number, and a boilerplate line counts once.  P-values are rounded up to quarter decades, so the ranks
  come from a histogram of bands and bins instead of a sort of all tokens.

DataFrame functions only.  The texts are read once; what is found is written
once and is small.  Positions come from the lengths of matches and of the
gaps between them, summed by a window over one document's matches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from postlake.llm.common import LOWER, UPPER, materialised

KINDS = ("assign", "access", "hex", "random")
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{16,}"  # the runs of 16 or more among the matches of [0-9a-f]+
TOKEN = "[A-Za-z0-9+/_-]{20,}={0,2}"
DIGITS = "0123456789"
#: name, shape, alphabet in the order its halves are taken; the first that fits is inferred
ENCODINGS = (
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef"),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base62", "^[A-Za-z0-9]+$", DIGITS + UPPER + LOWER),
    ("base64", "^[A-Za-z0-9+/]+$", DIGITS + UPPER + LOWER + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", DIGITS + UPPER + LOWER + "_-"),
    ("mixed", "", DIGITS + UPPER + LOWER + "+/_-"),
)
BANDS = (28, 40, 64)  # lengths at which the next band starts
TEXT_COINCIDENCE = 0.05  # two letters of ordinary text are equal at least this often
TEXT_HEX = 0.3  # share of a-f among the letters of ordinary text, at most
BIN = 4  # bins per power of ten of a p-value


def _matches(text: Column, kind: int, pattern: str, present: Column, ok: Column, with_text: bool = False) -> Column:
    """All matches in order: (kind, k, gap before, length, ok, token).  The
    last entry is the gap after the last match, with a NULL length."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
                          F.transform(found, F.length).alias("len"), ok.alias("ok"),
                          (found if with_text else F.transform(found, lambda _: F.lit(None).cast("string"))).alias("tok"))
    rows = F.transform(zipped, lambda x, k: F.struct(
        F.lit(kind).alias("kind"), k.alias("k"), x["gap"].alias("gap"), x["len"].alias("len"),
        x["ok"].alias("ok"), x["tok"].alias("tok")))
    return F.when(present, rows).otherwise(F.array().cast(
        "array<struct<kind:int,k:int,gap:int,len:int,ok:boolean,tok:string>>"))


def find_matches(text: Column) -> Column:
    def long_enough(pattern: str, group: int, least: int) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: F.length(x) >= least)
    return F.concat(
        _matches(text, 0, ASSIGN, (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & text.rlike(ASSIGN),
                 long_enough(ASSIGN, 2, 12)),
        _matches(text, 1, ACCESS, F.contains(text, F.lit("AKIA")), long_enough(ACCESS, 0, 18)),
        _matches(text, 2, HEX, text.rlike(HEX), long_enough(HEX, 0, 16)),
        _matches(text, 3, TOKEN, text.rlike(TOKEN), long_enough(TOKEN, 0, 20), with_text=True))


def two_sided(z: Column) -> Column:
    """P(|N(0,1)| > |z|), by a rational approximation of the error function
    (absolute error below 2e-7; fixed coefficients)."""
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    t = 1 / (1 + F.lit(0.3275911) * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * F.lit(1.061405429)))))
    return poly * F.exp(-x * x)


def battery(tokens: DataFrame) -> DataFrame:
    """Adds to ``tokens`` (column tok): enc, n, p_random (least p-value of the
    three tests times three), band and bin (quarter decades of the bound on
    the p-value under ordinary text, rounded towards one).  Tokens of digits
    only have no encoding and bin 0."""
    t = tokens.withColumn("core", F.rtrim(F.col("tok"), F.lit("=")))
    enc, alphabet = F.when(F.col("core").rlike("^[0-9]+$"), F.lit("decimal")), F.when(F.lit(False), F.lit(""))
    for name, shape, symbols in ENCODINGS:
        fits = F.col("core").rlike(shape) & ~F.col("core").rlike("^[0-9]+$")
        enc, alphabet = enc.when(fits, F.lit(name)), alphabet.when(fits, F.lit(symbols))
    t = t.withColumn("enc", enc).withColumn("alphabet", F.coalesce(alphabet, F.lit(DIGITS)))
    t = t.withColumn("core", F.when(F.col("enc") == "hex", F.lower("core")).otherwise(F.col("core")))
    core = F.col("core")
    counts = F.transform(F.array_distinct(F.split(core, "")), lambda c: (F.length(core) - F.length(F.replace(core, c))).cast("double"))
    zero = F.lit(0.0)
    half = F.translate(core, DIGITS + UPPER + LOWER + "+/_-", "")  # replaced below, by encoding
    for name, _, symbols in ENCODINGS:
        k = len(symbols) // 2
        half = F.when(F.col("enc") == name, F.translate(core, symbols, "0" * k + "1" * (len(symbols) - k))).otherwise(half)
    symbol = F.transform(F.split(core, ""), lambda c: F.instr(F.col("alphabet"), c).cast("double"))
    t = t.select("*", F.length("core").cast("double").alias("n"), F.length("alphabet").cast("double").alias("size"),
                 F.aggregate(counts, zero, lambda a, c: a + c * c).alias("squares"),
                 F.length(F.regexp_replace(half, "0+|1+", "x")).cast("double").alias("runs"),
                 F.length(F.regexp_replace(core, "[0-9]+", "")).cast("double").alias("letters"),
                 F.transform(symbol, lambda s: s - (F.length("alphabet") + 1) / F.lit(2.0)).alias("centred"))
    lagged = F.zip_with(F.slice("centred", F.lit(1), F.size("centred") - 1), F.slice("centred", F.lit(2), F.size("centred") - 1),
                        lambda a, b: a * b)
    n, size = F.col("n"), F.col("size")
    df = size - 1
    chi2 = size / n * F.col("squares") - n
    z_chi = (F.pow(F.greatest(chi2, zero) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    z_runs = (F.col("runs") - (1 + (n - 1) / 2)) / F.sqrt((n - 1) / 4)
    z_serial = F.aggregate(lagged, zero, lambda a, x: a + x) / ((size * size - 1) / 12 * F.sqrt(n - 1))
    pairs = F.lit(TEXT_COINCIDENCE) * n * (n - 1) / 2
    equal = (F.col("squares") - n) / 2
    tail = F.when(equal < pairs, pairs - equal + F.when(equal > 0, equal * F.log(equal / pairs)).otherwise(zero)).otherwise(zero)
    digits = F.when(F.col("enc") == "decimal", zero) \
        .when(F.col("enc") == "hex", F.col("letters") * F.lit(-math.log10(TEXT_HEX))) \
        .otherwise(tail / F.lit(math.log(10)))
    band = F.lit(0)
    for start in BANDS:
        band = band + (n >= start).cast("int")
    p = F.least(F.lit(1.0), 3 * F.least(two_sided(z_chi), two_sided(z_runs), two_sided(z_serial)))
    added = {"p_random": p, "band": band, "bin": F.least(F.floor(digits * BIN), F.lit(300 * BIN)).cast("int")}
    return t.select(*tokens.columns, "enc", "n", *[v.alias(k) for k, v in added.items()])


def thresholds(tested: DataFrame, q: float) -> DataFrame:
    """Benjamini-Hochberg over the distinct tokens of each length band: (band,
    least_bin).  One row a band, none where nothing is discovered."""
    hist = tested.select("tok", "band", "bin").distinct().groupBy("band", "bin").agg(F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy("band")
    above = whole.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = hist.select("band", "bin", F.sum("c").over(above).alias("rank"), F.sum("c").over(whole).alias("m"))
    return ranked.where(F.pow(F.lit(10.0), -F.col("bin") / BIN) * F.col("m") <= q * F.col("rank")) \
        .groupBy("band").agg(F.min("bin").alias("least_bin"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = 0.01,
                 battery_level: float = 0.001) -> DataFrame:
    """Secrets in each text.

    Returns one row per input row: the id and ``found``, an array of (start,
    kind number, end) by start, then kind; positions in code points, ends
    exclusive; kinds as in ``KINDS``.  Matches of the three shapes are found
    leftmost and non-overlapping per kind, and those too short are dropped
    without another try.  A random token that overlaps one of them is left
    out.

    Defined cases: a NULL or empty text has an empty array; repeated rows and
    ids are rows of their own; a token counts once in the false-discovery
    control, however often it occurs.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    found = docs.select(docs[id_col].alias("id"), find_matches(text).alias("m"))
    found = materialised(found.withColumn("uid", F.monotonically_increasing_id()))

    each = found.select("uid", F.explode("m").alias("x")).select("uid", "x.*")
    before = Window.partitionBy("uid", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.coalesce("len", F.lit(0))).over(before)) \
        .where("ok").select("uid", "kind", (F.col("end") - F.col("len")).alias("start"), "end", "tok")
    tested = materialised(battery(placed.where("kind = 3")))
    cut = thresholds(tested, q)  # one row for each of the four bands at most
    random = tested.join(F.broadcast(cut), "band").where(f"bin >= least_bin and p_random >= {battery_level}")
    spans = placed.where("kind < 3").select("uid", "kind", "start", "end") \
        .unionByName(random.select("uid", "kind", "start", "end"))

    # a random token goes if a known span that starts before it ends after its start, or one starts inside it
    order = Window.partitionBy("uid").orderBy("start", "kind")
    known_end, known_start = F.when(F.col("kind") < 3, F.col("end")), F.when(F.col("kind") < 3, F.col("start"))
    spans = spans.withColumn("reach", F.max(known_end).over(order.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("next", F.min(known_start).over(order.rowsBetween(0, Window.unboundedFollowing))) \
        .where("kind < 3 or (coalesce(reach, -1) <= start and coalesce(next, end) >= end)")
    by_doc = spans.groupBy(F.col("uid").alias("u")) \
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return found.join(by_doc, F.col("uid") == F.col("u"), "left") \
        .select(F.col("id").alias(id_col), F.coalesce("found", empty).alias("found"))


def spans_text(found: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
