"""Small literal sale-line frames for operator tests."""

from __future__ import annotations

from tillroll.schema import SALES_COLUMNS, SALES_SCHEMA

DEFAULTS = {
    "pos_code": "P1",
    "sale_date": "01-01-2017",
    "bill_no": "B1",
    "source_site": "S1",
    "customer_mobile": "9999999999",
    "rep_id": "R1",
    "rep_name": "Rep-1",
    "promo_name": "PR",
    "category": "C1",
    "sub_category": "SC1",
    "item_code": "I1",
    "item_attr": "A",
    "quantity": 1,
    "amount": 100,
    "measure_19": 90,
    "city": "City1",
    "state": "St1",
    "zone": "Z1",
    "pos_target": 10,
    "field_28": "x",
    "bad_fields": None,
}


def sale(**fields) -> dict:
    row = dict(DEFAULTS)
    row.update(fields)
    date = row["sale_date"]
    row["sale_year"] = date[6:10] if date else None
    return row


def frame(spark, *rows: dict):
    return spark.createDataFrame([tuple(r[c] for c in SALES_COLUMNS) for r in rows], SALES_SCHEMA)


def rows_of(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
