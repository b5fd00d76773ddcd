"""Time parsing."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.text import _col


def to_ts(c) -> Column:
    """Text to ``timestamp_ntz`` in the session's zone; NULL if unparsable.

    Accepts what a Spark cast accepts: ``yyyy-MM-dd[ HH:mm:ss[.SSS]]`` and the
    ISO ``T`` form.  Text without a zone keeps its wall clock; text with an
    offset or ``Z`` is moved to the session's zone, as ``to_timestamp`` does.
    Values already of a timestamp type are converted.
    """
    return F.try_to_timestamp(_col(c).cast("string")).cast("timestamp_ntz")
