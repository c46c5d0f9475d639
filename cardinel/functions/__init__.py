"""Column functions: parsing, ids, masking and text for notifications."""

from cardinel.functions.ids import alert_id, full_name, watchlist_number
from cardinel.functions.text import mask_card, money, risk_colour, shown, shown_time, yes_no
from cardinel.functions.times import parse_effective_from, parse_open_date

__all__ = [
    "alert_id",
    "full_name",
    "mask_card",
    "money",
    "parse_effective_from",
    "parse_open_date",
    "risk_colour",
    "shown",
    "shown_time",
    "watchlist_number",
    "yes_no",
]
