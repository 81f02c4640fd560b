"""Column expressions. All of them stay in the JVM; none is a Python UDF."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: Column | str, precision: int = 12) -> Column:
    return _column(value).cast(f"decimal({precision},2)")


def money_sum(value: Column | str) -> Column:
    """A sum of money in the widest type, whatever the input's precision."""
    return F.sum(value).cast("decimal(38,2)")


def mean(total: Column, n: Column) -> Column:
    """A mean from its sum and count, to four places."""
    return F.round(total.cast("double") / n, 4)


# --- dates ----------------------------------------------------------------------------


def _stamp(df: DataFrame, column: str, value: date | datetime) -> Column:
    """A constant of the column's own type, so that the comparison reaches the scan."""
    return F.lit(value.isoformat()).cast(df.schema[column].dataType)


def in_year(df: DataFrame, column: str, year: int) -> Column:
    """``year(column) = year`` as a half-open range, which Parquet can prune on."""
    stamp = F.col(column)
    return (stamp >= _stamp(df, column, date(year, 1, 1))) & (
        stamp < _stamp(df, column, date(year + 1, 1, 1))
    )


def between_stamps(df: DataFrame, column: str, first: date, last: date) -> Column:
    """Both ends included. A last day without a time means its midnight."""
    return F.col(column).between(_stamp(df, column, first), _stamp(df, column, last))


def on_days(df: DataFrame, column: str, first: date, last: date) -> Column:
    """From the first day to the end of the last day."""
    stamp = F.col(column)
    return (stamp >= _stamp(df, column, first)) & (
        stamp < _stamp(df, column, last + timedelta(days=1))
    )


def stamp_as_text(stamp: Column | str) -> Column:
    """A stamp as text such as ``Jul  4 2012 12:00:00:000AM``."""
    stamp = _column(stamp)
    return F.concat(
        F.date_format(stamp, "MMM"),
        F.lit(" "),
        F.lpad(F.dayofmonth(stamp).cast("string"), 2, " "),
        F.date_format(stamp, " yyyy hh:mm:ss:SSSa"),
    )


_STAMP_FORMAT = "MMM d yyyy hh:mm:ss:SSSa"


def stamp_from_text(text: Column | str) -> Column:
    """Text such as ``Jul  4 2012 12:00:00:000AM`` as a stamp; one-digit days are padded."""
    return F.to_timestamp_ntz(F.regexp_replace(_column(text), " +", " "), F.lit(_STAMP_FORMAT))


def is_stamp_text(text: Column | str) -> Column:
    """Whether ``stamp_from_text`` can read a text."""
    spaced = F.regexp_replace(_column(text), " +", " ")
    return F.try_to_timestamp(spaced, F.lit(_STAMP_FORMAT)).isNotNull()


# --- text -----------------------------------------------------------------------------


def contains_text(column: Column | str, text: str, ignore_case: bool = False) -> Column:
    """``column LIKE '%text%'``. As in LIKE, ``%`` and ``_`` in ``text`` are wildcards."""
    column = _column(column)
    if ignore_case:
        column = F.collate(column, "UTF8_LCASE")
    return column.like("%" + text.replace("\\", "\\\\") + "%")


def joined_text(*parts: Column | str, sep: str = " ") -> Column:
    """Parts joined by ``sep``; NULL if any part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit(sep), _column(part)]
    return F.concat(*pieces[1:])


# --- numbers --------------------------------------------------------------------------


def whole_quotient(a: Column, b: Column) -> Column:
    """Whole-number division that drops the fraction; ``/`` would give a double."""
    return F.call_function("div", a, b)


def discounted(quantity: Column | str, unit_price: Column | str, rate: Column | str) -> Column:
    """Price of a quantity after a discount rate, in DECIMAL(10,2)."""
    return (
        _column(quantity).cast("int")
        * _column(unit_price).cast("decimal(10,2)")
        * (F.lit(1) - _column(rate).cast("decimal(4,2)"))
    ).cast("decimal(10,2)")


def quotient(a: Column, b: Column) -> Column:
    """``a / b``, or NULL where it fails; ``quotient_error`` names the reason."""
    return F.try_divide(a, b)


def quotient_error(a: Column, b: Column) -> Column:
    failed = a.isNotNull() & b.isNotNull()
    return F.when(failed & (b == 0), "divide by zero").when(
        failed & quotient(a, b).isNull(), "arithmetic overflow"
    )
