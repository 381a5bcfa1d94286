"""O1: raw sale text in, typed sale lines out."""

from __future__ import annotations

import os

import pytest
from frames import frame, rows_of, sale
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillroll.plans.inspect import plan_summary, plan_text
from tillroll.plans.reports import REPORTS
from tillroll.schema import FIELD_POSITIONS, MEASURES, RAW_WIDTH, SALES_COLUMNS
from tillroll.sources import header_line, parse_sales_lines, read_sales_fact, read_sales_text, to_sales_lines, with_headers, write_sales_fact


def _write_lines(path: str, lines: list[str]) -> None:
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_round_trip_of_the_table_view_through_text(spark, oracle_sales, scratch):
    sample = oracle_sales.filter(F.col("bill_no").endswith("7"))  # a spread of bills, small file
    text_dir = os.path.join(scratch, "text")
    to_sales_lines(sample).write.text(text_dir)
    header = header_line()
    parsed = read_sales_text(spark, text_dir, header=header)
    assert parsed.columns == list(SALES_COLUMNS)
    assert parsed.exceptAll(sample).count() == 0
    assert sample.exceptAll(parsed).count() == 0


def test_header_blank_repeated_header_and_short_lines(spark, scratch):
    full = ",".join(
        ["152", "31-12-2017", "5979", "", "", "Site#1", "", "9999990899", "14", "Rep-14", "",
         "2-HIGH", "ECONOMY", "Brand#17", "1023", "", "A", "23", "68423", "65002",
         "City-0", "State", "ZONE", "", "", "", "", "8752", "11"]
    )
    header = header_line()
    short = ",".join(full.split(",")[:18])  # cut after field 17
    trailing_empty = ",".join(full.split(",")[:27] + ["", ""])
    path = os.path.join(scratch, "sales.csv")
    _write_lines(path, [header, full, "", header, short, trailing_empty])
    df = read_sales_text(spark, path)
    rows = df.orderBy("pos_target").collect()
    assert len(rows) == 3
    cut = [r for r in rows if r["amount"] is None][0]
    assert cut["quantity"] == 23 and cut["city"] == "" and cut["field_28"] == ""
    assert cut["pos_target"] is None
    empty_tail = [r for r in rows if r["amount"] is not None and r["field_28"] == ""][0]
    assert empty_tail["pos_target"] is None
    whole = [r for r in rows if r["field_28"] == "11"][0]
    assert whole["source_site"] == "Site#1" and whole["sub_category"] == "Brand#17"
    assert whole["quantity"] == 23 and whole["amount"] == 68423 and whole["measure_19"] == 65002
    assert whole["sale_year"] == "2017" and whole["pos_target"] == 8752


def test_first_line_is_the_header_when_not_given(spark, scratch):
    path = os.path.join(scratch, "sales.csv")
    line = ",".join(["1", "01-02-2017"] + [""] * 15 + ["5"])
    _write_lines(path, ["whatever header", line, "whatever header"])
    df = read_sales_text(spark, path)
    assert rows_of(df, "pos_code", "quantity") == [("1", 5)]


def _line(**fields) -> str:
    """A raw line with every field filled in, and ``fields`` as given."""
    values = {"sale_date": "01-02-2017"} | dict.fromkeys(MEASURES, "5") | fields
    names = {p: n for n, p in FIELD_POSITIONS.items()}
    return ",".join(values.get(names[i], names[i]) if i in names else "" for i in range(RAW_WIDTH))


@pytest.mark.parametrize("written", [False, True])
def test_strict_reports_fail_on_their_own_fields_only(spark, scratch, written):
    path = os.path.join(scratch, "sales.csv")
    _write_lines(path, [
        header_line(), _line(), _line(measure_19="abc"), _line(quantity="many", sale_date="01-02-2016"),
        _line(amount="x", promo_name=""), _line(sale_date="03-02-2017 10:15"),
    ])
    sales = read_sales_text(spark, path)
    if written:
        sales = read_sales_fact(spark, write_sales_fact(sales, os.path.join(scratch, "fact")))
    fails = {n for n, r in REPORTS.items() if n == "rep_subcategory_quantity" or "amount" in r.parsed and "promo_name" not in r.non_empty}
    assert "rep_daily_value" not in fails and "zone_subcategory_quantity" in fails
    for name, report in REPORTS.items():
        if name in fails:
            with pytest.raises(PySparkException, match="measure_19" if name == "rep_subcategory_quantity" else "amount"):
                report.run(sales, "2016").collect()
        else:
            assert report.run(sales, "2016").count() > 0, name
    assert sum(r["Count"] for r in REPORTS["daily_quantity"].run(sales, "2016").collect()) == 20


def test_strict_reports_fail_on_a_date_without_a_year(spark, scratch):
    path = os.path.join(scratch, "sales.csv")
    _write_lines(path, [header_line(), _line(), _line(sale_date="1-2-2017")])
    sales = read_sales_text(spark, path)
    for name, report in REPORTS.items():
        if report.year_rule:
            with pytest.raises(PySparkException, match="sale_date"):
                report.run(sales, "2016").collect()
        else:
            report.run(sales, "2016").collect()


def test_lenient_reports_drop_unreadable_lines(spark, scratch):
    path = os.path.join(scratch, "sales.csv")
    _write_lines(path, [header_line(), _line(), _line(quantity="abc"), _line(sale_date="1-2-2017")])
    sales = read_sales_text(spark, path, mode="lenient")
    assert [r["Count"] for r in REPORTS["daily_quantity"].run(sales, "2016").collect()] == [5]


def test_scorecard_of_lines_without_measures_has_null_sums(spark, scratch):
    path = os.path.join(scratch, "sales.csv")
    _write_lines(path, [header_line(), _line(quantity="", amount="7"), _line(quantity="", category="C")])
    rows = REPORTS["daily_category_scorecard"].run(read_sales_text(spark, path), "2016")
    assert {(r["Category"], r["Quantity"], r["Amount"]) for r in rows.collect()} == {("category", None, "7"), ("C", None, "5")}


def test_lenient_mode_nulls_bad_measure_and_bad_dates(spark, scratch):
    path = os.path.join(scratch, "sales.csv")
    base = [""] * 15
    _write_lines(
        path,
        [
            header_line(),
            ",".join(["1", "01-02-2017"] + base + ["abc"]),
            ",".join(["2", "1-2-2017"] + base + ["4"]),
            ",".join(["3", "32-01-2017"] + base + ["4"]),
        ],
    )
    df = read_sales_text(spark, path, mode="lenient")
    got = rows_of(df, "pos_code", "quantity", "sale_year")
    assert got == [("1", None, "2017"), ("2", 4, None), ("3", 4, None)]


def test_strict_mode_names_unreadable_fields(spark, scratch):
    path = os.path.join(scratch, "sales.csv")
    _write_lines(path, [header_line(), _line(sale_date="1-2-2017", quantity="x"), _line()])
    got = read_sales_text(spark, path).select("quantity", "sale_year", "bad_fields").collect()
    assert {tuple(r) for r in got} == {(None, None, ",quantity,sale_date,"), (5, "2017", None)}


def test_bad_mode_is_rejected(spark, scratch):
    path = os.path.join(scratch, "sales.csv")
    _write_lines(path, [header_line()])
    with pytest.raises(ValueError):
        read_sales_text(spark, path, mode="loose")


def test_text_lines_of_a_literal_frame(spark):
    line = to_sales_lines(frame(spark, sale())).collect()[0]["value"]
    parts = line.split(",")
    assert len(parts) == 29 and parts[1] == "01-01-2017" and parts[17] == "1" and parts[3] == ""


def test_rejected_lines_name_their_reason(spark, scratch):
    from tillroll.sources import rejected_lines

    path = os.path.join(scratch, "sales.csv")
    base = [""] * 15
    _write_lines(
        path,
        [
            header_line(),
            ",".join(["1", "01-02-2017"] + base + ["abc", "12"]),
            ",".join(["2", "32-01-2017"] + base + ["4", "x"]),
            ",".join(["3", "01-02-2017"] + base + ["4", "5"]),
        ],
    )
    got = sorted(
        (r["value"].split(",")[0], r["reason"])
        for r in rejected_lines(spark.read.text(path), header_line()).collect()
    )
    assert got == [
        ("1", "quantity is not a number"),
        ("2", "amount is not a number; sale_date is not dd-MM-yyyy"),
    ]


def test_empty_date_has_no_year_in_both_paths(spark, scratch):
    path = os.path.join(scratch, "sales.csv")
    base = [""] * 15
    _write_lines(path, [header_line(), ",".join(["1", ""] + base + ["4"]),
                        ",".join(["2", "01-02-2017", "B2"] + base[1:] + ["5"])])
    direct = read_sales_text(spark, path)
    assert rows_of(direct, "pos_code", "sale_year") == [("1", None), ("2", "2017")]
    fact = read_sales_fact(spark, write_sales_fact(direct, os.path.join(scratch, "fact")))
    for sales in (direct, fact):
        out = REPORTS["mobile_completeness"].run(sales, "2016")
        assert sum(r["Count"] for r in out.collect()) == 1


def test_every_file_starts_with_its_header(spark, scratch):
    lines = spark.range(700, numPartitions=7).select(F.concat(F.lit("line,"), F.col("id")).alias("value"))
    with_headers(lines, "a,header").write.text(scratch + "/headed")
    written = spark.read.text(scratch + "/headed").select("value", F.input_file_name().alias("file"))
    files = {}
    for r in written.collect():
        files.setdefault(r["file"], []).append(r["value"])
    assert len(files) == 7  # as many as tasks, not a fixed number
    assert all(f[0] == "a,header" and "a,header" not in f[1:] for f in files.values())
    assert sorted(v for f in files.values() for v in f[1:]) == sorted(f"line,{i}" for i in range(700))
    # The lines stay in their tasks.
    assert plan_summary(with_headers(lines, "a,header"))["exchanges"] == 0
    assert with_headers(lines.limit(0), "a,header").count() == 0


def test_a_line_is_split_and_parsed_once(spark, scratch):
    path = os.path.join(scratch, "sales.csv")
    _write_lines(path, [header_line(), _line()])
    plan = plan_text(REPORTS["daily_quantity"].run(read_sales_text(spark, path), "2016"), "extended")
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("split(") == 1 and physical.count("try_to_date") == 1
    assert physical.count("try_cast(") == len(MEASURES)


def test_rendered_lines_are_made_once_for_the_parse(spark):
    rows = frame(spark, sale(bill_no="7"), sale(bill_no="8")).withColumn("bill_no", F.concat("bill_no", F.lit("-shown")))
    parsed = parse_sales_lines(to_sales_lines(rows), header_line())
    plan = plan_text(parsed, "extended")
    assert plan[plan.index("== Physical Plan =="):].count("-shown") <= 1
    assert sorted(r["bill_no"] for r in parsed.collect()) == ["7-shown", "8-shown"]
