"""Age bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive age ranges and their labels, checked in this order;
# anything else (older, younger than 18, or unknown) is the last label.
AGE_BANDS = [(18, 24, "18-24"), (25, 35, "25-35"), (36, 50, "36-50")]
AGE_OTHER = "50+"


def age_group_sql(column: str = "age") -> str:
    """Age band label as a searched CASE.  Ages under 18 and NULL ages fall in
    ``50+``.  The one rule: the Column and the catalogue's function are made of it."""
    arms = " ".join(f"WHEN {column} BETWEEN {lo} AND {hi} THEN '{label}'"
                    for lo, hi, label in AGE_BANDS)
    return f"CASE {arms} ELSE '{AGE_OTHER}' END"


def age_group(column: str) -> Column:
    """The band of the column of that name."""
    return F.expr(age_group_sql("`" + column.replace("`", "``") + "`"))
