"""Column-level helpers (all built-in Spark expressions, codegen friendly)."""

from cardsentry.functions.constants import (
    EVENT_CITIES, EVENT_CONTRACT, EVENT_LOCKED, EVENT_OVERDUE, EVENT_PROBING,
    OPEN_END, RESULT_REJECT, RESULT_SUCCESS,
)
from cardsentry.functions.timecols import day_end, day_start, duration_us, epoch_us, ntz
from cardsentry.functions.values import parse_amount, parse_date_cell, parse_ts

__all__ = [
    "EVENT_CITIES", "EVENT_CONTRACT", "EVENT_LOCKED", "EVENT_OVERDUE", "EVENT_PROBING",
    "OPEN_END", "RESULT_REJECT", "RESULT_SUCCESS",
    "day_end", "day_start", "duration_us", "epoch_us", "ntz",
    "parse_amount", "parse_date_cell", "parse_ts",
]
