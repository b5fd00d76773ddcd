"""Column functions: each takes and returns a ``Column`` and stays JVM-side."""

from postlake.functions.bands import AGE_BANDS, age_group, age_group_sql
from postlake.functions.numbers import (expand_suffix, parse_follower_count,
                                        parse_follower_count_scaled, tolerant_int)
from postlake.functions.text import (POST_SENTINELS, full_name, null_if_in,
                                     percent_encode, strip_prefix)
from postlake.functions.time import to_ts

__all__ = [
    "AGE_BANDS", "age_group", "age_group_sql", "expand_suffix", "parse_follower_count",
    "parse_follower_count_scaled", "tolerant_int", "POST_SENTINELS", "full_name",
    "null_if_in", "percent_encode", "strip_prefix", "to_ts",
]
