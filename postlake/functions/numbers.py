"""Numeric parsing that tolerates bad input instead of failing the job.

Spark 4 runs with ANSI mode on, where a plain ``cast`` raises on text such as
``"n/a"``.  The functions here give NULL for such values and keep the
non-ANSI meaning for the rest: surrounding blanks and a sign are allowed, and a
fractional part is cut off (``"1.5000"`` is 1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.text import _col

# A plain decimal number: digits with an optional fraction, or a bare fraction
# (a lone "." reads as 0, as the non-ANSI cast has it).
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]*)\s*$"
INTEGER_PART = r"^\s*([+-]?[0-9]+)"
# The same number with an optional follower-count suffix.
SCALED_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]*)[kM]?\s*$"

# Suffix letter -> zeros appended (follower counts such as 5k, 3M).
SUFFIX_ZEROS = {"k": "000", "M": "000000"}


def tolerant_int(c) -> Column:
    """Text to int: NULL for non-numbers and overflow, fraction truncated.

    Plain integers take the fast path (``try_cast``, no regular expression);
    only the rest is matched against the number pattern.  Every
    sub-expression is used once, so nothing is evaluated twice per row.
    """
    c = _col(c)
    whole = F.regexp_extract(c, INTEGER_PART, 1)  # '' when no digit precedes the point
    truncated = F.coalesce(F.nullif(whole, F.lit("")), F.lit("0")).try_cast("int")
    return F.coalesce(c.try_cast("int"), F.when(c.rlike(NUMBER_PATTERN), truncated))


def expand_suffix(c) -> Column:
    """Replace a trailing ``k`` / ``M`` by its zeros, as text (``5k`` -> ``5000``).

    Only the last character is looked at, so ``1.5k`` becomes ``1.5000``.
    NULL and the empty string come back unchanged.
    """
    c = _col(c)
    body = F.left(c, F.length(c) - 1)
    out = None
    for letter, zeros in SUFFIX_ZEROS.items():
        cond = c.endswith(letter)
        value = F.concat(body, F.lit(zeros))
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(c)


def parse_follower_count(c) -> Column:
    """Follower count text to int: suffix expanded as text, then tolerant cast."""
    return tolerant_int(expand_suffix(c))


def parse_follower_count_scaled(c) -> Column:
    """Follower count with the suffix read as a multiplier: ``1.5k`` is 1500.

    Exact decimal shift done on the text: the suffix moves the decimal point
    (three places for ``k``, six for ``M``), digits beyond it are cut off, and
    the result goes through :func:`tolerant_int`.  Anything that is not a plain
    number with an optional suffix gives NULL, and so does int overflow.
    """
    c = _col(c)
    valid = c.rlike(SCALED_PATTERN)
    sign = F.regexp_extract(c, r"^\s*([+-]?)", 1)
    whole = F.regexp_extract(c, r"^\s*[+-]?([0-9]*)", 1)
    fraction = F.regexp_extract(c, r"\.([0-9]*)", 1)
    suffix = F.regexp_extract(c, r"([A-Za-z])\s*$", 1)
    places = F.lit(0)
    for letter, zeros in SUFFIX_ZEROS.items():
        places = F.when(suffix == letter, F.lit(len(zeros))).otherwise(places)
    digits = F.concat(whole, F.rpad(fraction, places, F.lit("0")))
    shifted = F.concat(sign, F.when(digits == "", F.lit("0")).otherwise(digits))
    return F.when(valid, tolerant_int(shifted))
