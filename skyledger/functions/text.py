"""Column expressions that turn untrusted text into typed values.

All of them give NULL for bad input whether ANSI mode is on or off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger import contract as C


def normalized_text(name: str) -> Column:
    """Text without outer spaces; empty becomes NULL. A tab is not a space and stays."""
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def is_missing(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)) == "", F.lit(True))


def is_present(name: str) -> Column:
    return ~is_missing(name)


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_int(text: Column) -> Column:
    """Whole number in front of an optional fraction: '12.7' gives 12, 'abc' or an overflow gives NULL."""
    whole = F.regexp_replace(text, r"^\s*([+-]?)([0-9]*)\.[0-9]*\s*$", "$10$2")
    return F.when(text.contains("."), whole).otherwise(text).try_cast("int")


def parse_flight_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(C.FLIGHT_DATE_FORMAT))


def parse_flight_date(text: Column) -> Column:
    return F.to_date(parse_flight_timestamp(text))


def safe_binary_flag(name: str) -> Column:
    """0 or 1 as int; every other value, 0.5 included, is NULL rather than truncated."""
    number = to_double(F.col(name))
    return F.when(number == 0.0, F.lit(0)).when(number == 1.0, F.lit(1))


def typed_column(name: str) -> Column:
    """The cleaned value of one raw column, by its contract type.

    Casts to a number ignore outer spaces and turn blank text into NULL themselves.
    """
    text = F.col(name)
    if name in C.FLAG_COLUMNS:
        return safe_binary_flag(name)
    if name in C.INT_COLUMNS:
        return to_int(text)
    if name in C.MEASURE_COLUMNS:
        return to_double(text)
    return parse_flight_date(F.trim(text)) if name == C.DATE_COLUMN else normalized_text(name)


def is_clock(text: Column) -> Column:
    """HHmm with 2400 allowed."""
    return text.rlike(C.CLOCK_PATTERN)
