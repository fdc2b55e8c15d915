"""Value parsing: missing markers, numbers, decimal commas, periods."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers for "no information", "withheld" and "not applicable".
MISSING_MARKERS = ["..", "...", "-", "X", ""]

# Tokens read as NA in delimited files, besides '' and ' '.
NA_TOKENS = [
    "", " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Digits may be grouped by single underscores; sign, fraction and exponent are optional.
_DIGITS = "[0-9]+(?:_[0-9]+)*"
NUMBER = rf"^\s*[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\s*$"
COMMA_NUMBER = r"^\s*[+-]?(?:[0-9]+,?[0-9]*|,[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"


def _unless(value: Column, *refused: object) -> Column:
    """The value, or NULL where it equals a refused one; a condition would work it out again for each time it is named."""
    return F.get(reduce(F.array_remove, refused, F.array(value)), F.lit(0))


def finite_double(text: Column) -> Column:
    """Text to double; NULL when it is not a finite number.

    Text of another shape is NULL before the cast, which would otherwise raise
    and catch an error inside for every such cell.
    """
    shaped = _unless(F.regexp_extract(text, NUMBER, 0), "")
    return _unless(F.replace(shaped, F.lit("_"), F.lit("")).try_cast("double"), float("inf"), float("-inf"))


def observation_value(raw: Column, missing: Sequence[str] = MISSING_MARKERS) -> Column:
    """A published cell: missing markers and unreadable text are NULL."""
    return F.when(~raw.isin(list(missing)), finite_double(raw))


def decimal_comma(
    text: Column,
    type_name: str = "double",
    thousands: str | None = None,
    na_tokens: Sequence[str] = NA_TOKENS,
) -> Column:
    """`1234,56` to a number. A thousands mark is read only when the contract names one."""
    bare = F.replace(text, F.lit(thousands), F.lit("")) if thousands else text
    number = F.translate(F.regexp_substr(bare, F.lit(COMMA_NUMBER)), ",", ".").try_cast(type_name)
    return F.when(~text.isin(list(na_tokens)), number)


def period_year(period: Column) -> Column:
    """Year of `2022` or `202201`; NULL when the text does not start with four digits."""
    return F.regexp_extract(period, "^([0-9]{4})", 1).try_cast("int")


def period_month(period: Column) -> Column:
    """Month of a six-digit period, else NULL."""
    return F.regexp_extract(period, "^[0-9]{4}(0[1-9]|1[0-2])$", 1).try_cast("int")


def in_calendar_window(period: Column, years: int | None, as_of_year: int) -> Column:
    """Year within `as_of_year - years` and `as_of_year`, both included; None keeps all."""
    if years is None:
        return F.lit(True)
    return period_year(period).between(as_of_year - years, as_of_year)
