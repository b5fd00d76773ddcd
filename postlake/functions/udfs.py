"""User-defined functions.

The native :func:`postlake.functions.parse_follower_count` is the default path.
This module keeps the Python form of the same rule as a vectorised pandas UDF:
it is checked against the native form in the tests and shows how user code
plugs in (Arrow batches, never one row at a time).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from postlake.functions.numbers import SUFFIX_ZEROS, tolerant_int


@F.pandas_udf(StringType())
def standardise_follower_count(s: pd.Series) -> pd.Series:
    """Text rule for follower counts: trailing ``k`` / ``M`` -> zeros.

    NULL and empty values pass through unchanged.
    """
    out = s.copy()
    present = s.notna() & (s.str.len() > 0)
    for letter, zeros in SUFFIX_ZEROS.items():
        hit = present & s.str.endswith(letter, na=False)
        out[hit] = s[hit].str[:-1] + zeros
    return out


def parse_follower_count_udf(c) -> Column:
    """Follower count via the pandas UDF, then the tolerant int cast."""
    col = F.col(c) if isinstance(c, str) else c
    return tolerant_int(standardise_follower_count(col))
