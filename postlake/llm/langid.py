"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed character n-grams (1 to 3 letters, all
else a space).  The weights are learnt with follow-the-regularised-leader
(FTRL-proximal) under an elastic-net penalty, which leaves most of them at
zero, and the scores are calibrated with one temperature fitted on labelled
rows kept out of the training.

Document frequencies are counted over all labelled training documents.  The
classifier itself is fitted on a bounded sample: ``per_class`` documents of each
language, chosen by small hashes of id and text.  Everything that
comes to the driver is bounded by the number of features and languages.
Prediction is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, FloatType, StringType, StructField,
                               StructType)

from postlake.llm.common import materialised, slices, text_key, with_python_columns

UNKNOWN = "und"
CHUNK = 1 << 20  # code points hashed at a time: bounds the memory for a very long text
_ASCII = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 else 32 for b in range(128)], np.uint32)
_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return _LETTER.search(text) is not None or any(c.isalpha() for c in set(text))


def gram_counts(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the text (1 to 3 code points) and their counts."""
    size = 1 << bits
    total = np.zeros(size, np.int64)
    shift = np.uint32(32 - bits)
    text = text.lower()
    for i in range(0, len(text), CHUNK):
        seen = min(i, 2)  # code points at the front that only begin n-grams of this chunk
        part = text[i - seen:i + CHUNK]
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.where(c < 128, _ASCII[c & 127], c) * np.uint32(2654435761)
        two = (c[:-1] ^ (c[:-1] >> np.uint32(15))) * np.uint32(2246822519) + c[1:]
        three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(3266489917) + c[2:]
        for gram in (c[seen:], two[max(0, seen - 1):] * np.uint32(668265263), three * np.uint32(374761393)):
            total += np.bincount(gram >> shift, minlength=size)
    at = np.flatnonzero(total)
    return at, total[at]


def vector(text: str, idf: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sparse TF-IDF vector of length one: feature numbers and weights."""
    at, n = gram_counts(text, bits)
    v = (1.0 + np.log(n)) * idf[at]
    norm = np.sqrt(v @ v)
    return at, v / norm if norm > 0 else v


@dataclass(frozen=True)
class Model:
    classes: tuple[str, ...]
    weights: np.ndarray  # features x classes
    bias: np.ndarray
    idf: np.ndarray
    temperature: float
    bits: int

    def logits(self, text: str) -> np.ndarray:
        at, v = vector(text, self.idf, self.bits)
        return v @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.classes or not has_letter(text):
            return UNKNOWN, 0.0
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        k = int(p.argmax())
        return self.classes[k], float(min(1.0, p[k] / p.sum()))


class Ftrl:
    """FTRL-proximal for multinomial logistic regression, per-coordinate rates."""

    def __init__(self, features: int, classes: int, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros((features + 1, classes)), np.zeros((features + 1, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, v: np.ndarray, label: int) -> None:
        at, v = np.append(at, len(self.z) - 1), np.append(v, 1.0)  # the last feature is the bias
        w = self.weights(at)
        s = v @ w
        p = np.exp(s - s.max())
        p /= p.sum()
        p[label] -= 1.0
        g = v[:, None] * p[None, :]
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: CRC-32 of the id as text is 2 modulo 4 (a NULL
    id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def document_frequencies(docs: DataFrame, text_col: str, bits: int) -> tuple[int, np.ndarray]:
    """Number of documents, and for each feature in how many it occurs.  Each
    task sends one row per feature; they are summed before the driver reads
    2^bits + 1 numbers."""
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                total[gram_counts(text, bits)[0]] += 1
                total[size] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["feature", "n"])

    rows = docs.select(docs[text_col]).where(docs[text_col].isNotNull()).mapInArrow(count, "feature int, n long") \
        .groupBy("feature").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(size + 1, np.int64)
    for r in rows:
        df[r["feature"]] = r["n"]
    return int(df[size]), df[:size]


#: Temperatures that are tried, one per cent apart.
TEMPERATURES = np.geomspace(0.05, 20.0, 600)


def _calibration_sums(z: np.ndarray, label: int) -> np.ndarray:
    """What one row of logits adds to the cross-entropy at every temperature:
    log of the sum of exp(z / t); then the sum of z, the label's z, and 1."""
    scaled = (z - z.max())[None, :] / TEMPERATURES[:, None]
    return np.concatenate([np.log(np.exp(scaled).sum(axis=1)) + z.max() / TEMPERATURES, [z.sum(), z[label], 1.0]])


def _temperature(sums: np.ndarray, classes: int) -> float:
    """The temperature with the least cross-entropy, from the sums of
    :func:`_calibration_sums`.  The labels are smoothed by one case of each
    class, so that a sample without an error does not make all scores one."""
    *logs, z_all, z_label, n = sums
    if not n:
        return 1.0
    want = (z_all + n * z_label) / (n + classes)
    return float(TEMPERATURES[np.argmin(np.array(logs) - want / TEMPERATURES)])


def fit(docs: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id",
        bits: int = 15, per_class: int = 1000, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0,
        l1: float = 0.02, l2: float = 0.01, max_classes: int = 1000) -> Model:
    """Fit a model to the rows of ``docs`` with a label and a text with letters.

    ``per_class`` bounds the sample: about that many documents of a language,
    never more (repeated rows count once), four in five to learn from and one
    to calibrate with.  ``max_classes`` bounds the number of languages.  They pass one task in batches, ``epochs`` times; it keeps
    the weights only.  Without any labelled row the model has no classes.
    """
    spark = docs.sparkSession
    labelled = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[label_col].alias("label")) \
        .where("label is not null and text is not null").withColumn("h", F.xxhash64("id", text_key(F.col("text"))))
    n, df = document_frequencies(labelled, "text", bits)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0

    # hashes are uniform, so a language's share below this cut is about per_class documents; no sort of its rows
    lettered = labelled.where(F.col("text").rlike(r"\p{L}"))
    sizes = lettered.groupBy("label").count().limit(max_classes + 1).collect()
    if len(sizes) > max_classes:
        raise ValueError(f"more than {max_classes} languages")
    cuts = [(r["label"], -(1 << 63) + min((1 << 64) - 1, (per_class << 64) // r["count"])) for r in sizes]
    cut = F.broadcast(spark.createDataFrame(cuts, "label string, cut long"))  # max_classes rows at most
    place = F.row_number().over(Window.partitionBy("label").orderBy("h"))
    sample = lettered.join(cut, "label").where("h <= cut").dropDuplicates(["label", "h"]) \
        .withColumn("place", place).where(F.col("place") <= per_class) \
        .select("label", "h", "text").withColumn("fold", F.pmod(F.shiftrightunsigned("h", 20), F.lit(5)))
    sample = materialised(sample)
    classes = tuple(sorted(r[0] for r in sample.select("label").distinct().collect()))
    none = Model((), np.zeros((1 << bits, 0)), np.zeros(0), idf, 1.0, bits)
    if not classes:
        return none
    sent = spark.sparkContext.broadcast((classes, idf))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights_idf = sent.value
        number = {c: k for k, c in enumerate(names)}
        model = Ftrl(1 << bits, len(names), alpha, beta, l1, l2)
        for batch in slices(batches):
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                model.learn(*vector(text, weights_idf, bits), number[label])
        w = model.weights(slice(None)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array(list(names)), pa.array(list(w.T))], ["label", "w"])

    passes = sample.where("fold > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))) \
        .repartition(1).sortWithinPartitions("epoch", F.xxhash64("epoch", "h")).select("label", "text")
    learnt = {c: np.zeros((1 << bits) + 1) for c in classes} | {r["label"]: np.array(r["w"]) for r in passes.mapInArrow(
        learn, StructType([StructField("label", StringType()), StructField("w", ArrayType(FloatType()))])).collect()}
    w = np.stack([learnt[c] for c in classes], axis=1)
    model = Model(classes, w[:-1], w[-1], idf, 1.0, bits)

    fitted = spark.sparkContext.broadcast(model)

    def calibrate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = np.zeros(len(TEMPERATURES) + 3), {c: k for k, c in enumerate(fitted.value.classes)}
        for batch in slices(batches):
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total += _calibration_sums(np.asarray(fitted.value.logits(text), float), number[label])
        yield pa.RecordBatch.from_arrays([pa.array([list(total)])], ["sums"])

    # each task sends one row of sums, whatever the rows and languages; they are added before the driver sees them
    parts = sample.where("fold = 0").select("label", "text").mapInArrow(calibrate, "sums array<double>") \
        .select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("sum")).collect()
    sums = np.zeros(len(TEMPERATURES) + 3)
    for r in parts:
        sums[r["pos"]] = r["sum"]
    t = _temperature(sums, len(classes))
    return Model(classes, w[:-1], w[-1], idf, t, bits)


def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.classes or not has_letter(text):
            return UNKNOWN, 0.0
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        k = int(p.argmax())
        return self.classes[k], float(min(1.0, p[k] / p.sum()))


class Ftrl:
    """FTRL-proximal for multinomial logistic regression, per-coordinate rates."""

    def __init__(self, features: int, classes: int, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros((features + 1, classes)), np.zeros((features + 1, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, v: np.ndarray, label: int) -> None:
        at, v = np.append(at, len(self.z) - 1), np.append(v, 1.0)  # the last feature is the bias
        w = self.weights(at)
        s = v @ w
        p = np.exp(s - s.max())
        p /= p.sum()
        p[label] -= 1.0
        g = v[:, None] * p[None, :]
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: CRC-32 of the id as text is 2 modulo 4 (a NULL
    id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def document_frequencies(docs: DataFrame, text_col: str, bits: int) -> tuple[int, np.ndarray]:
    """Number of documents, and for each feature in how many it occurs.  Each
    task sends one row per feature; they are summed before the driver reads
    2^bits + 1 numbers."""
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                total[gram_counts(text, bits)[0]] += 1
                total[size] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["feature", "n"])

    rows = docs.select(docs[text_col]).where(docs[text_col].isNotNull()).mapInArrow(count, "feature int, n long") \
        .groupBy("feature").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(size + 1, np.int64)
    for r in rows:
        df[r["feature"]] = r["n"]
    return int(df[size]), df[:size]


#: Temperatures that are tried, one per cent apart.
TEMPERATURES = np.geomspace(0.05, 20.0, 600)


def _calibration_sums(z: np.ndarray, label: int) -> np.ndarray:
    """What one row of logits adds to the cross-entropy at every temperature:
    log of the sum of exp(z / t); then the sum of z, the label's z, and 1."""
    scaled = (z - z.max())[None, :] / TEMPERATURES[:, None]
    return np.concatenate([np.log(np.exp(scaled).sum(axis=1)) + z.max() / TEMPERATURES, [z.sum(), z[label], 1.0]])


def _temperature(sums: np.ndarray, classes: int) -> float:
    """The temperature with the least cross-entropy, from the sums of
    :func:`_calibration_sums`.  The labels are smoothed by one case of each
    class, so that a sample without an error does not make all scores one."""
    *logs, z_all, z_label, n = sums
    if not n:
        return 1.0
    want = (z_all + n * z_label) / (n + classes)
    return float(TEMPERATURES[np.argmin(np.array(logs) - want / TEMPERATURES)])


def fit(docs: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id",
        bits: int = 15, per_class: int = 1000, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0,
        l1: float = 0.02, l2: float = 0.01, max_classes: int = 1000) -> Model:
    """Fit a model to the rows of ``docs`` with a label and a text with letters.

    ``per_class`` bounds the sample: about that many documents of a language,
    never more (repeated rows count once), four in five to learn from and one
    to calibrate with.  ``max_classes`` bounds the number of languages.  They pass one task in batches, ``epochs`` times; it keeps
    the weights only.  Without any labelled row the model has no classes.
    """
    spark = docs.sparkSession
    labelled = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[label_col].alias("label")) \
        .where("label is not null and text is not null").withColumn("h", F.xxhash64("id", text_key(F.col("text"))))
    n, df = document_frequencies(labelled, "text", bits)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0

    # hashes are uniform, so a language's share below this cut is about per_class documents; no sort of its rows
    lettered = labelled.where(F.col("text").rlike(r"\p{L}"))
    sizes = lettered.groupBy("label").count().limit(max_classes + 1).collect()
    if len(sizes) > max_classes:
        raise ValueError(f"more than {max_classes} languages")
    cuts = [(r["label"], -(1 << 63) + min((1 << 64) - 1, (per_class << 64) // r["count"])) for r in sizes]
    cut = F.broadcast(spark.createDataFrame(cuts, "label string, cut long"))  # max_classes rows at most
    place = F.row_number().over(Window.partitionBy("label").orderBy("h"))
    sample = lettered.join(cut, "label").where("h <= cut").dropDuplicates(["label", "h"]) \
        .withColumn("place", place).where(F.col("place") <= per_class) \
        .select("label", "h", "text").withColumn("fold", F.pmod(F.shiftrightunsigned("h", 20), F.lit(5)))
    sample = materialised(sample)
    classes = tuple(sorted(r[0] for r in sample.select("label").distinct().collect()))
    none = Model((), np.zeros((1 << bits, 0)), np.zeros(0), idf, 1.0, bits)
    if not classes:
        return none
    sent = spark.sparkContext.broadcast((classes, idf))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights_idf = sent.value
        number = {c: k for k, c in enumerate(names)}
        model = Ftrl(1 << bits, len(names), alpha, beta, l1, l2)
        for batch in slices(batches):
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                model.learn(*vector(text, weights_idf, bits), number[label])
        w = model.weights(slice(None)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array(list(names)), pa.array(list(w.T))], ["label", "w"])

    passes = sample.where("fold > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))) \
        .repartition(1).sortWithinPartitions("epoch", F.xxhash64("epoch", "h")).select("label", "text")
    learnt = {c: np.zeros((1 << bits) + 1) for c in classes} | {r["label"]: np.array(r["w"]) for r in passes.mapInArrow(
        learn, StructType([StructField("label", StringType()), StructField("w", ArrayType(FloatType()))])).collect()}
    w = np.stack([learnt[c] for c in classes], axis=1)
    model = Model(classes, w[:-1], w[-1], idf, 1.0, bits)

    fitted = spark.sparkContext.broadcast(model)

    def calibrate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = np.zeros(len(TEMPERATURES) + 3), {c: k for k, c in enumerate(fitted.value.classes)}
        for batch in slices(batches):
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total += _calibration_sums(np.asarray(fitted.value.logits(text), float), number[label])
        yield pa.RecordBatch.from_arrays([pa.array([list(total)])], ["sums"])

    # each task sends one row of sums, whatever the rows and languages; they are added before the driver sees them
    parts = sample.where("fold = 0").select("label", "text").mapInArrow(calibrate, "sums array<double>") \
        .select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("sum")).collect()
    sums = np.zeros(len(TEMPERATURES) + 3)
    for r in parts:
        sums[r["pos"]] = r["sum"]
    t = _temperature(sums, len(classes))
    return Model(classes, w[:-1], w[-1], idf, t, bits)


def _logits(sent):
    def make():
        return lambda texts: ([sent.value.logits(t).tolist() for t in texts],)
    return make


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None,
            min_score: float | None = None) -> DataFrame:
    """The input rows with ``lang_pred`` and ``score`` (0 to 1); input columns
    of these names are replaced.  With ``min_score``, rows whose language is
    unknown or scores less are left out.

    Defined cases: ``und`` with score 0 if the text is NULL, empty or has no
    letter, or if nothing was learnt; ties go to the first language in order.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    if min_score is not None:
        fields.append(StructField("accepted", BooleanType()))

    def make():
        def run(texts):
            got = [sent.value.predict(t) for t in texts]
            out = [g[0] for g in got], [g[1] for g in got]
            return out if min_score is None else (*out, [g[0] != UNKNOWN and g[1] >= min_score for g in got])
        return run
    return with_python_columns(docs, [text_col], StructType(fields), make, keep=keep,
                               where=None if min_score is None else "accepted")
