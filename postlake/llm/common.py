"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from postlake.session import checkpoint_root

#: The six ASCII white-space characters that separate words (fixed value).
WHITE_SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialised(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept under the shared checkpoint folder.

    A reliable checkpoint: it cuts the lineage, and losing an executor loses
    nothing.  Used where one result feeds several later jobs.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  Texts that are pure ASCII take the fast path, in
    which ``lower`` does the same."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def text_key(text: Column) -> Column:
    """A 64-bit key of a text; with the id it names a row across shuffles."""
    return F.xxhash64(F.lit("row"), F.coalesce(text, F.lit("")), text.isNull())


#: Rows of an Arrow batch that Python holds as objects at a time.
SLICE = 64


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows: a worker then needs memory for
    few texts, whatever the batch size of the session."""
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            yield batch.slice(i, SLICE)
    pa.default_memory_pool().release_unused()


def with_python_columns(df: DataFrame, inputs: list[str], outputs: StructType,
                        make: Callable[[], Callable], keep: list[str] | None = None,
                        where: str | None = None) -> DataFrame:
    """Append columns computed by Python, one Arrow batch at a time, no shuffle.

    ``make()`` runs once per task and returns ``f(*lists)`` giving one list per
    field of ``outputs``.  The input columns in ``keep`` (default: all) pass
    through as Arrow arrays without being converted; an input column named
    like an output is replaced by it.  ``where`` names a boolean output: rows
    where it is not true are left out, and the column itself too.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in outputs.names]
    mark = "__in" + "_" * max((len(c) for c in keep), default=0)  # longer than any column's name
    src = df.select(*[df[c] for c in keep], *[df[c].alias(f"{mark}{i}") for i, c in enumerate(inputs)])
    out_fields = [f for f in outputs.fields if f.name != where]
    schema = StructType(src.schema.fields[:len(keep)] + out_fields)
    types = [(f.name, to_arrow_type(f.dataType)) for f in outputs.fields]
    n_keep, n_in = len(keep), len(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in slices(batches):
            lists = [batch.column(n_keep + i).to_pylist() for i in range(n_in)]
            arrays, names, mask = [batch.column(i) for i in range(n_keep)], list(keep), None
            for (name, kind), values in zip(types, f(*lists), strict=True):
                if name == where:
                    mask = pa.array(values, pa.bool_())
                else:
                    arrays.append(pa.array(values, kind))
                    names.append(name)
            out = pa.RecordBatch.from_arrays(arrays, names)
            yield out if mask is None else out.filter(mask)

    return src.mapInArrow(run, schema)
