"""Text cleaning functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The placeholder text each raw posts column carries when the
# source had nothing.  Matched exactly; the empty string is treated the same.
POST_SENTINELS = {
    "description": "No description available Story format",
    "follower_count": "User Info Error",
    "image_src": "Image src error.",
    "is_image_or_video": "multi-video(story page format)",
    "poster_name": "User Info Error",
    "tag_list": "N,o, ,T,a,g,s, ,A,v,a,i,l,a,b,l,e",
    "title": "No Title Data Available",
}

# Fixed value: the prefix removed from ``save_location``.
SAVE_LOCATION_PREFIX = "Local save in "


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_in(c, *values: str) -> Column:
    """NULL where the value equals one of ``values`` exactly, else the value."""
    c = _col(c)
    return F.when(c.isin(*values), F.lit(None)).otherwise(c)


def strip_prefix(c, prefix: str = SAVE_LOCATION_PREFIX) -> Column:
    """Remove every occurrence of ``prefix`` (literal text, not anchored)."""
    return F.replace(_col(c), F.lit(prefix), F.lit(""))


def full_name(first, last) -> Column:
    """First and last name joined by one space; NULL parts are skipped."""
    return F.concat_ws(" ", _col(first), _col(last))


def percent_encode(c) -> Column:
    """Percent-encode UTF-8 text with no safe characters.

    Only ``A-Z a-z 0-9 _ . - ~`` stay as they are, as with Python's
    ``urllib.parse.quote(s, safe="")``.  ``url_encode`` follows the HTML form
    rules instead (space as ``+``, ``*`` kept, ``~`` encoded), and a literal
    ``+`` always comes out as ``%2B``, so three literal replacements turn one
    form into the other without leaving the JVM.
    """
    encoded = F.url_encode(_col(c))
    encoded = F.replace(encoded, F.lit("+"), F.lit("%20"))
    encoded = F.replace(encoded, F.lit("*"), F.lit("%2A"))
    return F.replace(encoded, F.lit("%7E"), F.lit("~"))
