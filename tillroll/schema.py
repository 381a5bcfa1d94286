"""The sale-line data model.

One row per sold item. The raw form is a comma-separated text line with a
header; the typed form is a DataFrame with the columns below plus the derived
``sale_year`` used by the year rule (and as the partition column of a
materialised fact).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Positions of the fields in a raw sale line (0-based, split on
# ","). They must equal the source layout for the reports to read the right
# fields. Positions 3, 4, 6, 10, 15 and 23-26 are never read.
FIELD_POSITIONS: dict[str, int] = {
    "pos_code": 0,
    "sale_date": 1,
    "bill_no": 2,
    "source_site": 5,
    "customer_mobile": 7,
    "rep_id": 8,
    "rep_name": 9,
    "promo_name": 11,
    "category": 12,
    "sub_category": 13,
    "item_code": 14,
    "item_attr": 16,
    "quantity": 17,
    "amount": 18,
    "measure_19": 19,
    "city": 20,
    "state": 21,
    "zone": 22,
    "pos_target": 27,
    "field_28": 28,
}

# Number of positions in a full raw line.
RAW_WIDTH = 29

# The date text layout and the default year the reports leave out.
DATE_FORMAT = "dd-MM-yyyy"
DEFAULT_EXCLUDED_YEAR = "2016"

# Mobile-number lengths counted as "filled in".
VALID_MOBILE_LENGTHS = (10, 11, 12)

# Labels written into the reports. Quarters in order (months
# 1-3, 4-6, 7-9, 10-12); the mobile flag as (filled in, not filled in); the
# constant count of the daily scorecard.
QUARTER_LABELS = ("Qtr1", "Qtr2", "Qtr3", "Qtr4")
MOBILE_LABELS = ("Yes", "No")
SCORECARD_COUNT = "1"

# Fields with values that may be unreadable, and the column that names those of a line
# as ",quantity,sale_date,"; null in a line without any.
BAD_FIELDS = "bad_fields"

# Partition column of a written fact: whether the line has unreadable fields.
IS_BAD = "is_bad"

MEASURES = ("quantity", "amount", "measure_19", "pos_target")

SALES_SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType() if name in MEASURES else T.StringType())
        for name in FIELD_POSITIONS
    ]
    + [T.StructField(BAD_FIELDS, T.StringType()), T.StructField("sale_year", T.StringType())]
)

SALES_COLUMNS = tuple(f.name for f in SALES_SCHEMA.fields)
