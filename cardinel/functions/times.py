"""Text to date and time, giving NULL for text that does not parse.

The try_ forms matter: under ANSI rules the plain ones raise an error on the
first bad value, which would stop a stream for good.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The time formats of watchlist files and customer records.
EFFECTIVE_FROM_FORMAT = "dd-MMM-yyyy HH:mm:ss"
OPEN_DATE_FORMAT = "yyyy-MM-dd"


def parse_effective_from(text: Column | str) -> Column:
    return F.try_to_timestamp(text, F.lit(EFFECTIVE_FROM_FORMAT))


def parse_open_date(text: Column | str) -> Column:
    return F.try_to_timestamp(text, F.lit(OPEN_DATE_FORMAT)).cast("date")
