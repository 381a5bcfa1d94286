"""O2 and O3: the row filters every report starts with."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import non_empty, year_text
from tillroll.schema import BAD_FIELDS, DEFAULT_EXCLUDED_YEAR, MEASURES


def require_non_empty(sales: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrame:
    """O2: keep rows where every listed field is present (non-empty / non-null).

    One conjunction in one ``Filter``; Catalyst pushes the null checks into the
    parquet scan.
    """
    if not columns:
        return sales
    types = {f.name: f.dataType for f in sales.schema.fields}
    predicate = reduce(lambda a, b: a & b, (non_empty(c, types[c]) for c in columns))
    return sales.filter(predicate)


def readable_rows(
    sales: DataFrame, columns: tuple[str, ...], year: str | None, parsed: tuple[str, ...]
) -> DataFrame:
    """O2 and O3 over lines that may name unreadable fields (``bad_fields``).

    A line is judged as the source jobs do: by the text of its fields first and by
    its year, and only a line that is left is parsed. So the query fails if such a
    line names one of ``parsed``, and lines that name other fields are judged by
    the values they have. ``year=None``: no year rule.

    The first filter holds plain comparisons only, which reach the scan as pushed
    and partition filters; it lets lines with unreadable fields through. What
    comes after reads the parsed fields through a check that fails, so no later
    filter on them can be moved below the check.
    """
    types = {f.name: f.dataType for f in sales.schema.fields}
    bad = F.col(BAD_FIELDS)
    loose, exact, checked = [], [], {}
    for c in columns:
        present = non_empty(c, types[c])
        measure = c in parsed and c in MEASURES
        loose.append(present | bad.isNotNull() if measure else present)
        if measure:
            exact.append(present)
    for c in parsed:
        if c in MEASURES:
            checked[c] = _readable(c, F.col(c))
    if year is not None:
        other = F.col("sale_year") != F.lit(year)
        loose.append(other | F.col("sale_year").isNull())
        exact.append(_readable("sale_date", other))
    rows = sales.filter(reduce(and_, loose)) if loose else sales
    rows = rows.withColumns(checked) if checked else rows
    return rows.filter(reduce(and_, exact)) if exact else rows


def _readable(field: str, value: Column) -> Column:
    """``value``, but an error in a line whose ``field`` is unreadable."""
    bad = F.col(BAD_FIELDS)
    message = F.concat(F.lit(f"a line that the report reads has an unreadable {field}; its unreadable fields: "), bad)
    return F.when(bad.contains(f",{field},"), F.raise_error(message)).otherwise(value)


def exclude_year(sales: DataFrame, year: str = DEFAULT_EXCLUDED_YEAR) -> DataFrame:
    """O3: drop rows whose date text has ``year`` in characters 7-10.

    Uses the ``sale_year`` column when present (a partition column of a written
    fact, so the filter prunes whole directories), else the date text itself.
    """
    if "sale_year" in sales.columns:
        return sales.filter(F.col("sale_year") != F.lit(year))
    return sales.filter(year_text("sale_date") != F.lit(year))
