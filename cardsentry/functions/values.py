"""Typed parsing of text fields (ANSI-safe: failures become NULL, never errors)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT_TYPE = "decimal(18,2)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_amount(col) -> Column:
    """Amount text with a decimal point or a decimal comma -> exact decimal(18,2); NULL if it is
    malformed or has more decimals than that (rounding could turn a strict decrease into a tie)."""
    text = F.regexp_replace(F.trim(_c(col)), ",", ".")
    amount = _try_cast(text, AMOUNT_TYPE)
    return F.when(_try_cast(text, "decimal(38,18)") == amount, amount)


def parse_ts(col) -> Column:
    """'YYYY-MM-DD HH:MM:SS[.ffffff]' text -> timestamp_ntz (NULL when malformed)."""
    return _try_cast(F.trim(_c(col)), "timestamp_ntz")


def parse_date_cell(col) -> Column:
    """A spreadsheet date cell: an Excel serial day number, ISO or dd.MM.yyyy text -> date (NULL when malformed)."""
    c = F.trim(_c(col))
    serial = _try_cast(c, "double")
    from_serial = F.date_add(F.lit("1899-12-30").cast("date"), F.floor(serial).cast("int"))
    return F.when(serial.isNotNull(), from_serial).otherwise(F.coalesce(
        _try_cast(F.substring(c, 1, 10), "date"),
        _try_cast(F.regexp_replace(c, r"^(\d{1,2})\.(\d{1,2})\.(\d{4}).*$", "$3-$2-$1"), "date")))


def _try_cast(col: Column, type_name: str) -> Column:
    return col.try_cast(type_name)
