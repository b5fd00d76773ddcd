"""A corpus-cleaning pipeline of five stages, each one operator of
``postlake.llm``; each stage's result is written as Parquet and read again as
the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from postlake.llm import decontaminate, langid, line_dedup, mixing, simhash
from postlake.llm.common import table, text_key
from postlake.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _carried(docs: DataFrame) -> DataFrame:
    """The columns the operators use, and each whole row as the struct
    ``document``: no name that an operator uses can meet a column of the input."""
    return docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), docs["source"].alias("source"),
                       text_key(docs["text"]).alias("own"), F.struct("*").alias("document"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with a score of 0.5 or more.  Learnt
    from the labelled documents that are not held out.

    Defined cases: NULL, empty and letterless texts go, as their language is
    unknown.  Repeated rows stay as often as they come, a NULL id is never held
    out, and all input columns are returned as they are."""
    model = langid.fit(docs.where(~F.coalesce(langid.held_out(docs["doc_id"]), F.lit(False))))
    return langid.predict(_carried(docs), model, keep=["document"], min_score=0.5).select("document.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that three documents or more share; a column
    ``n_chars``, if there is one, follows the text.

    Defined cases: a NULL text stays NULL; a text whose lines all go is empty;
    rows of one id (NULL ids together) are one document for the count, and
    each stays a row.  All other columns are returned as they are."""
    out = line_dedup.dedup_lines(docs, carry=True)
    text = F.when(F.col("doc.text").isNotNull(), F.col("kept_text"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return out.select(*[new[c].alias(c) if c in new else F.col("doc").getField(c).alias(c) for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the smallest id.

    Defined cases: NULL and empty texts are one group.  Of rows with the same id
    and text one stays, whichever.  A NULL id is larger than any other.  All
    columns are returned as they are."""
    marks = simhash.near_duplicates(docs.select("doc_id", "text"), shingle=3, max_bits=2).where("keep") \
        .select(F.col("doc_id").alias("m_id"), F.col("row").alias("m_own")).distinct()
    rows = _carried(docs).select("doc_id", "own", "document")
    kept = rows.join(marks, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("own") == F.col("m_own")))
    # a row that is repeated as it is would stay as often; one copy is enough
    return kept.dropDuplicates(["doc_id", "own"]).select("document.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word in a benchmark window.

    Defined cases: NULL and empty texts have no words and stay; repeated rows
    and NULL ids are rows like others; all columns are returned as they are."""
    marked = decontaminate.mark_contaminated(_carried(docs), table(spark, sf_dir, "benchmark"), keep=["document"])
    return marked.where("n_hit = 0").select("document.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, numbered by ``copy``; those
    with no copy go.

    Defined cases: a text without words has one copy.  Repeated rows (the same
    id and text) are written from one of them, as often as all together have
    copies.  If the input has a column ``copy``, in any case, the number's
    column is ``copy_`` with as many underscores as make it new; the others
    are returned as they are."""
    plan = mixing.mix(docs.select("doc_id", "text", "source")).where("copies > 0") \
        .groupBy(F.col("doc_id").alias("p_id"), F.col("row").alias("p_own"), F.col("size").alias("p_size")) \
        .agg(F.sum("copies").cast("int").alias("copies"))
    # repeated rows share a key: each key is written as often as its rows together have copies
    rows = _carried(docs).select("doc_id", "own", "document").dropDuplicates(["doc_id", "own"])
    taken = rows.join(plan, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("own") == F.col("p_own")))
    number = "copy"
    while number in {c.lower() for c in docs.columns}:
        number += "_"
    return taken.select("document", F.explode(F.sequence(F.lit(1), "copies")).alias("number")) \
        .select("document.*", F.col("number").alias(number))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: Language identification and entropy balancing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each read back from its Parquet."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline", name, unique=True)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
