"""Values as a notification shows them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a card number, a risk level and a missing value are shown.
CARD_MASK = "**** **** **** "
CARD_HIDDEN = "****"
RISK_COLOURS = {
    "CRITICAL": "#b91c1c",
    "HIGH": "#d9534f",
    "MEDIUM": "#f0ad4e",
    "LOW": "#5cb85c",
}
OTHER_RISK_COLOUR = "#6c757d"
MISSING = "None"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def mask_card(card: Column | str) -> Column:
    """All but the last four digits hidden; everything, if there are fewer."""
    card = _column(card)
    return F.when(
        F.length(card) >= 4, F.concat(F.lit(CARD_MASK), F.substring(card, -4, 4))
    ).otherwise(CARD_HIDDEN)


def risk_colour(level: Column | str) -> Column:
    """Badge colour of a risk level in any case; grey for any other value."""
    level = F.upper(_column(level))
    known = [F.when(level == name, colour) for name, colour in RISK_COLOURS.items()]
    return F.coalesce(*known, F.lit(OTHER_RISK_COLOUR))


def yes_no(flag: Column | str) -> Column:
    return F.when(_column(flag), "Yes").otherwise("No")


def money(amount: Column | str) -> Column:
    """Two decimals and thousands separators; NULL stays NULL."""
    return F.format_number(_column(amount), 2)


def shown(value: Column | str) -> Column:
    return F.coalesce(_column(value).cast("string"), F.lit(MISSING))


def shown_time(time: Column | str) -> Column:
    """A time to the second, with six decimals only where it has a fraction."""
    time = _column(time)
    pattern = "yyyy-MM-dd HH:mm:ss"
    whole = F.date_trunc("second", time) == time
    return F.coalesce(
        F.when(whole, F.date_format(time, pattern)).otherwise(
            F.date_format(time, pattern + ".SSSSSS")
        ),
        F.lit(MISSING),
    )
