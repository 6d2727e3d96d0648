from barlake.functions.dates import (
    history_start, month_end, months_ago, next_day, previous_quarter_end, quarter_end,
    to_day, ymd,
)
from barlake.functions.numbers import cents, from_cents, ratio, round_half_up
from barlake.functions.text import clean_text, contains_like, to_integer, to_number

__all__ = [
    "cents", "clean_text", "contains_like", "from_cents", "history_start", "month_end",
    "months_ago", "next_day", "previous_quarter_end", "quarter_end", "ratio",
    "round_half_up", "to_day", "to_integer", "to_number", "ymd",
]
