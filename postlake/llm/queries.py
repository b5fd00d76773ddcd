"""One query per operator over the whole test tables, and DuckDB SQL where SQL
can express the result.  The queries are thin: they call the operator and
derive the digest columns of their contract from its outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postlake.llm import (
    decontaminate, exact_dedup, langid, licenses, line_dedup, manifest, mixing, pii, quality, secret_scan, simhash,
    spelling, substring_dedup,
)
from postlake.llm.common import ascii_lower, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that near-repeat across documents."""
    out = substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return out.select("doc_id", "component_id", F.size("spans").cast("long").alias("n_spans"), "copies",
                      F.array_join(spans, ",").alias("spans"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-word shingles, links at two bits or fewer."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return out.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def _counts(found: Column, kinds: tuple[str, ...], n: int) -> list[Column]:
    """A count for each of the first ``n`` kinds."""
    def of(k: int) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == k)).cast("long")
    return [of(k).alias(f"n_{kinds[k]}") for k in range(n)]


def _digests(found: Column, kinds: tuple[str, ...], n: int) -> list[Column]:
    """SHA-256 of the spans of the first ``n`` kinds, and all spans."""
    base = F.filter(found, lambda s: s["kind"] < n)
    return [F.sha2(secret_scan.spans_text(base, kinds), 256).alias("base_sha256"),
            secret_scan.spans_text(found, kinds).alias("spans")]


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known shapes, and random tokens at a false-discovery rate of 1 %."""
    out = secret_scan.scan_secrets(table(spark, sf_dir, "documents"), q=0.01)
    found = F.col("found")
    return out.select("doc_id", *_counts(found, secret_scan.KINDS, 3), *_digests(found, secret_scan.KINDS, 3))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 2 % of a language's good documents rejected, with 95 % confidence over all."""
    out = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), risk=0.02, delta=0.05)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices with 80 % of a template's five-word shingles."""
    out = licenses.find_licenses(table(spark, sf_dir, "documents"), containment=0.8, keep=["doc_id"])
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"], m["end"]))
    return out.select("doc_id", F.size("matches").cast("long").alias("n_matches"),
                      F.array_join("licenses", ",").alias("licenses"), F.array_join(spans, ",").alias("spans"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the rows not held out, predicts all."""
    docs = table(spark, sf_dir, "documents")
    held = langid.held_out(docs["doc_id"])
    model = langid.fit(docs.where(~held))
    out = langid.predict(docs, model, keep=["doc_id"])
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern spans and those of the field."""
    out = pii.find_personal_data(table(spark, sf_dir, "documents"))
    found = F.array_sort(F.concat("base", "added"))
    base = F.col("base")
    return out.select("doc_id", *_counts(base, pii.KINDS, 4),
                      F.sha2(secret_scan.spans_text(base, pii.KINDS), 256).alias("base_sha256"),
                      secret_scan.spans_text(found, pii.KINDS).alias("spans"), F.size("added").alias("n_added"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 20 code points or more in three documents or more."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_chars=20, min_docs=3)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 3, 1, 2 in turn, 150 % of all words, two copies at most."""
    out = mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, max_copies=2)
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of ten words of the benchmark items."""
    out = decontaminate.mark_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                          window=10, keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letter runs of seven code points or more that occur twice or more, a
    31st of them with one letter deleted; forms are ten times as frequent."""
    docs = table(spark, sf_dir, "documents")
    runs = docs.select("doc_id", F.explode(spelling.letter_runs(F.col("text"), 7)).alias("run")) \
        .select("doc_id", ascii_lower(F.col("run")).alias("run"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "run").cast("binary"))  # NULL for a NULL id: nothing is cut
    cut = (h % F.length("run")).cast("int")
    word = F.when(h % 31 == 0, F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.length("run")))) \
        .otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where("length(word) >= 7").groupBy("word") \
        .agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    return spelling.group_variants(words, ratio=10)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three children a node; every second row's text is tampered with."""
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    docs = table(spark, sf_dir, "documents")
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(odd, F.translate("text", "\n", "")).otherwise(F.col("text"))
    read = manifest.leaf_digest([tampered if c == "text" else F.col(c) for c in fields])
    out = manifest.manifest(docs.withColumn("read", read), fields=fields, fanout=3, keep=["read"])
    folded = manifest.fold(F.col("read"), F.col("path"))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.proof_text(F.col("path")), 256).alias("proof_sha256"),
                      folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts equal byte for byte; the largest id of a group stays."""
    docs = table(spark, sf_dir, "documents").withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    out = exact_dedup.dedup_exact(docs, keep=["text_sha256"])
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_quality_rules": op4_quality_rules,
    "op5_license_scan": op5_license_scan,
    "op6_language_id": op6_language_id,
    "op7_personal_data": op7_personal_data,
    "op8_line_dedup": op8_line_dedup,
    "op9_entropy_balancing": op9_entropy_balancing,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_exact_dedup": op13_exact_dedup,
}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# unsigned crc32 of a string s, from the table of the reflected polynomial 0xEDB88320
_CRC_TABLE = """SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
  ORDER BY i) AS t FROM range(256) r(i)"""


def _crc32(s: str) -> str:
    octets = f"list_transform(range(strlen({s})), lambda k: CAST('0x' || substr(hex(encode({s})), 2 * k + 1, 2) AS BIGINT))"
    return f"xor(list_reduce([4294967295] || {octets}, lambda c, o: xor(c // 256, crc.t[xor(c % 256, o) + 1])), 4294967295)"


ORACLE: dict[str, str] = {
    "op8_line_dedup": rf"""
WITH line AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_AZ}) AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
shared AS (
  SELECT key, max(doc_id) AS last FROM line WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.doc_id, pos, line, s.key IS NOT NULL AND l.doc_id <> s.last AS gone
  FROM line l LEFT JOIN shared s ON l.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op10_benchmark_decontamination": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS s
  FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
        FROM b WHERE len(w) > 0)),
spot AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
        FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hit AS (SELECT doc_id, item_id, spot.k, p FROM spot JOIN win ON spot.k = win.k AND spot.s = win.s),
n AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + k)) FROM hit) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN i ON d.doc_id = i.doc_id""",
    "op11_spelling_variants": f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
run AS (
  SELECT doc_id, translate(r, {_AZ}) AS r, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM documents)
  WHERE length(r) >= 7 GROUP BY ALL),
hashed AS (SELECT r, n, {_crc32("(CAST(doc_id AS VARCHAR) || ':' || r)")} AS h FROM run, crc),
word AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word,
    CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2),
less AS (
  SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM word)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN word b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN word b ON a.rest = b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word),
best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, hex(encode(near)))) AS near, max(near_n) AS near_n FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
    CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM word w LEFT JOIN best b ON w.word = b.word),
way AS (
  SELECT word, word AS here, 0 AS k FROM formed
  UNION ALL SELECT way.word, f.form, k + 1 FROM way JOIN formed f ON way.here = f.word WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n
FROM formed f JOIN (SELECT word, arg_max(here, k) AS root FROM way GROUP BY word) r ON f.word = r.word""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
doc AS (
  SELECT doc_id, source, text, {{leaf}} AS leaf,
    CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed,
    lang, n_chars FROM documents, crc),
leaf AS (
  SELECT doc_id, leaf, {{read}} AS read, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS p,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS m FROM doc),
node AS (
  SELECT 0 AS level, p, pos, m, leaf AS h FROM leaf
  UNION ALL SELECT any_value(level) + 1, p, pos // 3, any_value((m + 2) // 3), sha256(string_agg(h, '' ORDER BY pos))
  FROM node WHERE m > 1 GROUP BY p, pos // 3),
top AS (SELECT 0 AS level, p AS pos, h, p, count(*) OVER () AS m FROM node WHERE m = 1),
crown AS (
  SELECT 0 AS level, pos, m, h FROM top
  UNION ALL SELECT any_value(level) + 1, pos // 3, any_value((m + 2) // 3), sha256(string_agg(h, '' ORDER BY pos))
  FROM crown WHERE m > 1 GROUP BY pos // 3),
step AS (
  SELECT doc_id, p, 0 AS k, 0 AS level, pos, m, false AS up, '' AS proof, read AS folded FROM leaf
  UNION ALL
  SELECT s.doc_id, s.p, k + 1, CASE WHEN s.m = 1 THEN 0 ELSE s.level + 1 END,
    CASE WHEN s.m = 1 THEN s.p ELSE s.pos // 3 END, CASE WHEN s.m = 1 THEN (SELECT count(*) FROM top) ELSE (s.m + 2) // 3 END,
    s.up OR s.m = 1, proof || coalesce(lhs, '') || coalesce(rhs, ''),
    CASE WHEN s.m = 1 THEN folded ELSE sha256(coalesce(lhs, '') || folded || coalesce(rhs, '')) END
  FROM step s LEFT JOIN (
    SELECT a.up, a.level, a.p, a.pos, string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos) AS lhs,
      string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos) AS rhs
    FROM (SELECT false AS up, level, p, pos, h FROM node WHERE m > 1 UNION ALL SELECT true, level, 0, pos, h FROM crown WHERE m > 1) a
    JOIN (SELECT false AS up, level, p, pos, h FROM node WHERE m > 1 UNION ALL SELECT true, level, 0, pos, h FROM crown WHERE m > 1) b
      ON a.up = b.up AND a.level = b.level AND a.p = b.p AND a.pos // 3 = b.pos // 3
    GROUP BY ALL) side
  ON s.m > 1 AND side.up = s.up AND side.level = s.level AND side.p = CASE WHEN s.up THEN 0 ELSE s.p END AND side.pos = s.pos
  WHERE s.m > 1 OR NOT s.up),
last AS (SELECT doc_id, p, proof, folded FROM step WHERE up AND m = 1)
SELECT l.doc_id, l.leaf, t.h AS subroot, (SELECT h FROM crown WHERE m = 1) AS root, sha256(proof) AS proof_sha256,
  folded AS folded_root, folded = (SELECT h FROM crown WHERE m = 1) AS verified
FROM leaf l JOIN top t ON l.p = t.p JOIN last ON l.doc_id IS NOT DISTINCT FROM last.doc_id AND l.p = last.p""",
    "op13_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}


def _leaf_sql(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(
        f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in fields) + ")"


ORACLE["op12_merkle_manifest"] = ORACLE["op12_merkle_manifest"].format(leaf=_leaf_sql("text"), read=_leaf_sql("changed"))
