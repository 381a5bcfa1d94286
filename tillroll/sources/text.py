"""O1: the raw sales text (one comma-separated sale line per row, with a header).

Rules, same as the source jobs:

* every line equal to the header is dropped (not only the first one), and so
  is every empty line;
* fields are split on a plain ``,`` (quotes are not honoured); a position past
  the end of a short line reads as ``''``;
* measures are parsed as 64-bit integers; an empty measure is ``null`` so the
  non-empty rule drops it.

A non-numeric measure, or the year of an unreadable date, reads as ``null``.
``mode="strict"`` names such fields in the line's ``bad_fields``, and a report
fails if a line that it keeps has one among the fields that it reads. So, as in
the source jobs, a bad value in a field or year that a report never reads does
not concern it. ``mode="lenient"`` names none: reports drop such lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import year_text
from tillroll.schema import BAD_FIELDS, DATE_FORMAT, FIELD_POSITIONS, MEASURES, RAW_WIDTH, SALES_COLUMNS

MODES = ("strict", "lenient")


def _field(parts: Column, position: int) -> Column:
    # F.get returns null past the end of the array (no ANSI index error).
    return F.coalesce(F.get(parts, position), F.lit(""))


def _measure(raw: Column) -> Column:
    return raw.try_cast(T.LongType())


def _once(value: Column) -> Column:
    """``value`` as a generator of one row, for ``select``.

    The optimizer writes a column's expression into every filter and column above that
    names it, and a filter evaluates each of these copies for itself. It does so past a
    projection but not past a generator, so what is costly is evaluated once a line. The
    code generated for many copies is also too long for the JVM to compile.
    """
    return F.explode(F.array(value))


def _split_lines(lines: DataFrame, header: str | None) -> DataFrame:
    """``value, parts, day, *MEASURES``: the lines that are not empty nor the header, their
    fields, and the parsed ones among them: null for an empty or unreadable field."""
    value = F.col("value")
    kept = lines.filter(value != "")
    if header is not None:
        kept = kept.filter(value != header)
    split = kept.select("value", _once(F.split(value, ",", -1)).alias("parts"))
    parts = F.col("parts")
    # Text after the day, such as a time, is let through, as the source's parser does.
    day = F.try_to_date(F.substring(_field(parts, FIELD_POSITIONS["sale_date"]), 1, 10), DATE_FORMAT)
    measures = (_measure(_field(parts, FIELD_POSITIONS[n])).alias(n) for n in MEASURES)
    return split.select("value", "parts", F.inline(F.array(F.struct(day.alias("day"), *measures))))


def _unreadable(name: str, parsed: str) -> Column:
    """Whether the field is not empty and yet ``parsed`` from it has no value."""
    return (_field(F.col("parts"), FIELD_POSITIONS[name]) != "") & F.col(parsed).isNull()


def _sale_year(sale_date: Column) -> Column:
    # An empty date has no year (null), so the year rule drops the line; this
    # also survives a round trip through a year-partitioned table, where an
    # empty partition value would come back as null anyway.
    return F.when((sale_date != "") & F.col("day").isNotNull(), year_text(sale_date))


def _bad_names() -> Column:
    """Names of the line's unreadable fields, each between commas; one comma for none."""
    bad = {n: _unreadable(n, n) for n in MEASURES} | {"sale_date": _unreadable("sale_date", "day")}
    return F.concat_ws("", F.lit(","), *(F.when(c, F.lit(f"{n},")) for n, c in bad.items()))


def parse_sales_lines(lines: DataFrame, header: str | None, mode: str = "strict") -> DataFrame:
    """Typed sale lines from a one-column (``value``) DataFrame of raw lines."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    split = _split_lines(lines, header)
    if mode == "strict":
        split = split.select("parts", "day", *MEASURES, _once(_bad_names()).alias("names"))
        bad = F.when(F.col("names") != ",", F.col("names"))
    else:
        bad = F.lit(None).cast(T.StringType())
    raw = {name: _field(F.col("parts"), position) for name, position in FIELD_POSITIONS.items()}
    columns = (name if name in MEASURES else value.alias(name) for name, value in raw.items())
    year = _sale_year(raw["sale_date"])
    return split.select(*columns, bad.alias(BAD_FIELDS), year.alias("sale_year")).select(*SALES_COLUMNS)


def first_line(lines: DataFrame) -> str | None:
    """The first line of the input, which is its header when none is given."""
    first = lines.first()
    return first[0] if first is not None else None


def read_sales_text(
    spark: SparkSession,
    path: str,
    mode: str = "strict",
    header: str | None = None,
) -> DataFrame:
    """Read raw sale text files into typed sale lines.

    ``header`` is the header line to drop; when not given, the first line of
    the input is taken as the header (one small action on the driver).
    """
    lines = spark.read.text(path)
    return parse_sales_lines(lines, first_line(lines) if header is None else header, mode)


def rejected_lines(lines: DataFrame, header: str | None) -> DataFrame:
    """Lines the lenient mode would keep with a ``null`` in place of a bad value.

    Returns ``value, reason`` rows (a non-numeric measure, or a date that is not
    ``dd-MM-yyyy``), so a run can count or store its rejects next to its
    reports. Distributed like the parse itself; nothing is collected.
    """
    split = _split_lines(lines, header)
    reasons = [F.when(_unreadable(name, name), F.lit(f"{name} is not a number")) for name in MEASURES]
    reasons.append(F.when(_unreadable("sale_date", "day"), F.lit("sale_date is not dd-MM-yyyy")))
    reason = F.concat_ws("; ", *reasons)
    return split.select("value", reason.alias("reason")).filter(F.col("reason") != "")


def header_line() -> str:
    """A header naming every position (unused positions as ``unused_N``)."""
    names = {p: n for n, p in FIELD_POSITIONS.items()}
    return ",".join(names.get(i, f"unused_{i}") for i in range(RAW_WIDTH))


def with_headers(lines: DataFrame, header: str) -> DataFrame:
    """The lines (``value``) as :meth:`DataFrameWriter.text` has to write them so that every file
    starts with ``header``.

    A task writes one file, so the header goes before the first line of each task; the lines stay
    where they are, whatever their number, and nothing is shuffled.
    """
    row_of_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    value = F.col("value")
    return lines.select(F.when(row_of_task == 0, F.concat(F.lit(f"{header}\n"), value)).otherwise(value).alias("value"))


def to_sales_lines(sales: DataFrame) -> DataFrame:
    """The inverse of :func:`parse_sales_lines`: typed sale lines to raw text rows."""
    names = {p: n for n, p in FIELD_POSITIONS.items()}
    fields = []
    for i in range(RAW_WIDTH):
        name = names.get(i)
        if name is None:
            fields.append(F.lit(""))
        else:
            fields.append(F.coalesce(F.col(name).cast(T.StringType()), F.lit("")))
    return sales.select(_once(F.concat_ws(",", *fields)).alias("value"))
