"""Identifiers and names put together from, or taken apart into, columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator of alert ids, and the prefix of watchlist ids, which
# is followed by a number (WL000001).
ID_SEPARATOR = "-"
WATCHLIST_PREFIX = "WL"


def alert_id(prefix: str, *parts: Column | str) -> Column:
    """Prefix and parts joined by dashes; missing parts are left out."""
    return F.concat_ws(ID_SEPARATOR, F.lit(prefix), *parts)


def full_name(first: Column | str, last: Column | str) -> Column:
    """First and last name; an empty text if both are missing."""
    return F.concat_ws(" ", first, last)


def watchlist_number(watchlist_id: Column | str) -> Column:
    """The number in a watchlist id, NULL where there is none."""
    text = F.col(watchlist_id) if isinstance(watchlist_id, str) else watchlist_id
    digits = F.substring(text, len(WATCHLIST_PREFIX) + 1, 2**31 - 1)
    return F.when(text.startswith(WATCHLIST_PREFIX), digits.try_cast("long"))
