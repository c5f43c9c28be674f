"""Casts from raw text that give NULL instead of failing.

Raw columns are all text. The rules below fix how each kind of text becomes a
typed value, so that a row means the same on any engine:

* text to integer goes through a double and rounds halves away from zero;
* a double to integer rounds halves to the even neighbour;
* a date needs year, month and day, with ``-`` or ``/`` used twice.

Arguments are SQL expressions as text, mostly a column name. Each function is one
SQL expression too, which keeps wide staging projections quick to plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_SHAPE = r"^\\d{4}([-/])\\d{1,2}\\1\\d{1,2}$"


def _double(x: str) -> str:
    # The JVM number parser takes a type suffix ("1d", "5f"); such a value is junk in
    # a CSV. Infinity is the one number whose text ends in such a letter.
    text = f"trim({x})"
    suffixed = f"right({text}, 1) in ('d', 'D', 'f', 'F') and not lower(right({text}, 3)) <=> 'inf'"
    return f"case when not ({suffixed}) then try_cast({x} as double) end"


def _int(x: str) -> str:
    return f"try_cast(round({_double(x)}) as int)"


def _date(x: str) -> str:
    # The usual form is told by position; only other texts pay for the pattern.
    text = f"trim({x})"
    usual = f"length({text}) = 10 and substring({text}, 5, 1) = '-' and substring({text}, 8, 1) = '-'"
    return (
        f"case when {usual} then try_cast({text} as date) "
        f"when {text} rlike '{DATE_SHAPE}' then try_cast(translate({text}, '/', '-') as date) end"
    )


def try_double(x: str) -> Column:
    """Text as double, NULL when it is not a number."""
    return F.expr(_double(x))


def try_int(x: str) -> Column:
    """Text as integer; ``'4.0'`` is 4 and ``'2.5'`` is 3."""
    return F.expr(_int(x))


def double_to_int(x: str) -> Column:
    """Double as integer, halves to even: 2.5 is 2 and 1.5 is 2."""
    return F.expr(f"try_cast(rint({x}) as int)")


def try_date(x: str) -> Column:
    """Text as date; partial dates such as ``'2022-06'`` give NULL."""
    return F.expr(_date(x))


def leading_date(x: str) -> Column:
    """The date in the first ten characters of a timestamp text."""
    return F.expr(_date(f"left({x}, 10)"))


def flag(x: str) -> Column:
    """Text flag as boolean: true for 1, NULL for junk."""
    return F.expr(f"{_int(x)} = 1")


def double_flag(x: str) -> Column:
    """Text flag that may hold a fraction: true for what rounds to 1, halves to even."""
    return F.expr(f"try_cast(rint({_double(x)}) as int) = 1")


def blank_to_null(x: str) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.expr(f"nullif(trim({x}), '')")


def empty_to_null(x: str) -> Column:
    """Text as it is, NULL when empty; blanks stay."""
    return F.expr(f"nullif({x}, '')")


def surrogate_key(*parts: str, sep: str = "|") -> Column:
    """md5 over the joined values; NULL values are left out."""
    return F.expr(f"md5(concat_ws('{sep}', {', '.join(parts)}))")


def band(column: str, cuts: Sequence[tuple[float, str]], top: str) -> Column:
    """Label of the first band whose upper bound exceeds the value.

    ``cuts`` are ``(upper bound, label)`` in rising order. Values at or above the
    last bound get ``top`` and NULL stays NULL.
    """
    c = F.col(column)
    out = F.when(c < cuts[0][0], cuts[0][1])
    for upper, label in cuts[1:]:
        out = out.when(c < upper, label)
    return out.when(c >= cuts[-1][0], top)
