"""Scalar column functions.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so the
expressions stay inside whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schema import DATE_FORMAT, MOBILE_LABELS, QUARTER_LABELS, VALID_MOBILE_LENGTHS

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_text(sale_date: ColumnOrName) -> Column:
    """Characters 7-10 of a ``dd-MM-yyyy`` text (the year part)."""
    return F.substring(_col(sale_date), 7, 4)


def month_text(sale_date: ColumnOrName) -> Column:
    """Characters 4-5 of a ``dd-MM-yyyy`` text (the month part)."""
    return F.substring(_col(sale_date), 4, 2)


def day_of(sale_date: ColumnOrName) -> Column:
    """The date text as a ``DateType`` value (raises on a bad date under ANSI); text
    after the day, such as a time, is left out."""
    return F.to_date(F.substring(_col(sale_date), 1, 10), DATE_FORMAT)


def quarter_label(month: ColumnOrName) -> Column:
    """Quarter label of a month number: 10-12 Qtr4, 7-9 Qtr3, 4-6 Qtr2, else Qtr1."""
    m = _col(month)
    q1, q2, q3, q4 = QUARTER_LABELS
    return (
        F.when(m > 9, F.lit(q4))
        .when(m > 6, F.lit(q3))
        .when(m > 3, F.lit(q2))
        .otherwise(F.lit(q1))
    )


def mobile_filled(mobile: ColumnOrName) -> Column:
    """True when a mobile number has one of the accepted lengths."""
    return F.length(_col(mobile)).isin(*VALID_MOBILE_LENGTHS)


def mobile_label(filled: ColumnOrName) -> Column:
    """``Yes`` / ``No`` from a boolean flag."""
    yes, no = MOBILE_LABELS
    return F.when(_col(filled), F.lit(yes)).otherwise(F.lit(no))


def int_ratio(numerator: str, denominator: str) -> Column:
    """Integer division truncating toward zero (SQL ``div``), as a bigint."""
    return F.expr(f"`{numerator}` div `{denominator}`")


def float_ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """32-bit float quotient of two values first cast to 32-bit float."""
    n = _col(numerator).cast(T.FloatType())
    d = _col(denominator).cast(T.FloatType())
    return (n / d).cast(T.FloatType())


def non_empty(c: ColumnOrName, data_type: T.DataType) -> Column:
    """A field is present: a non-empty string, or a non-null value otherwise."""
    col = _col(c)
    if isinstance(data_type, T.StringType):
        return col.isNotNull() & (col != F.lit(""))
    return col.isNotNull()
