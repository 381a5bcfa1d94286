"""The report catalogue: every report as (row rules, operator, output names).

Each report takes typed sale lines and returns a DataFrame; nothing is
collected. The row rules differ per report and are part of its meaning:

* ``non_empty``: the fields that must be present (O2);
* ``year_rule``: whether rows of the excluded year are dropped (O3).

Report names are snake_case; output column names are the sink field names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import day_of
from tillroll.operators import (
    avg_per_day,
    daily_category_scorecard,
    dimension_catalog,
    exclude_year,
    measure_by,
    mobile_completeness,
    monthly_by_quarter,
    pos_target_sum,
    readable_rows,
    require_non_empty,
    top_items,
)
from tillroll.schema import BAD_FIELDS, DEFAULT_EXCLUDED_YEAR, MEASURES


@dataclass(frozen=True)
class Report:
    name: str
    description: str
    non_empty: tuple[str, ...]
    year_rule: bool
    build: Callable[[DataFrame], DataFrame]
    reads: tuple[str, ...] = ()

    @property
    def parsed(self) -> tuple[str, ...]:
        """The fields that the report parses: measures, and the date for its year."""
        fields = {*self.non_empty, *self.reads} & {*MEASURES}
        return tuple(sorted(fields | ({"sale_date"} if self.year_rule else set())))

    def rows(self, sales: DataFrame, excluded_year: str = DEFAULT_EXCLUDED_YEAR) -> DataFrame:
        """The sale lines this report aggregates (after its row rules)."""
        if BAD_FIELDS in sales.columns:
            return readable_rows(sales, self.non_empty, excluded_year if self.year_rule else None, self.parsed)
        rows = require_non_empty(sales, self.non_empty)
        if self.year_rule:
            rows = exclude_year(rows, excluded_year)
        return rows

    def run(self, sales: DataFrame, excluded_year: str = DEFAULT_EXCLUDED_YEAR) -> DataFrame:
        return self.build(self.rows(sales, excluded_year))


REPORTS: dict[str, Report] = {}

# Reports that are ranked, and so can be cut to their first rows.
RANKINGS = ("item_ranking", "zone_item_ranking")

# Reports that group by bill or by item and place, with about one group per sale line.
MANY_GROUPS = (*RANKINGS, "mobile_completeness", "zone_mobile_completeness", "rep_mobile_completeness")


def _report(
    name: str, description: str, non_empty: tuple[str, ...] = (), year_rule: bool = True, reads: tuple[str, ...] = ()
):
    def register(build: Callable[[DataFrame], DataFrame]):
        REPORTS[name] = Report(name, description, tuple(non_empty), year_rule, build, reads)
        return build

    return register


def _named(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Select ``(source column, output name)`` pairs in order; ``date`` is
    converted from the date text."""
    cols = []
    for src, out in pairs:
        cols.append(day_of(src).alias(out) if out == "date" else F.col(src).alias(out))
    return df.select(*cols)


# The sink field names of the reports, as (source column, field
# name) pairs shared by several reports.
DATE = ("sale_date", "date")
SITE = ("source_site", "SourceSite")
CITY = ("city", "City")
STATE = ("state", "State")
ZONE = ("zone", "Zone")
CATEGORY = ("category", "Category")
SUBCATEGORY = ("sub_category", "SubCategory")
PROMO = ("promo_name", "PromoName")
REP_ID = ("rep_id", "SalesRepNameid")
REP_NAME = ("rep_name", "SalesRepName")
PERSON_ID = ("rep_id", "SalespersonId")
PERSON = ("rep_name", "Salesperson")
POS = ("pos_code", "PosCode")

GEO = ("source_site", "city", "state", "zone")
REP = ("rep_id", "rep_name", "promo_name", "category")


# --- overall sums (O4, O5) -------------------------------------------------

@_report("daily_quantity", "quantity sold per day", ("sale_date", "quantity"))
def _daily_quantity(rows):
    out = measure_by(rows, ["sale_date"], "quantity", alias="Count")
    return _named(out, DATE, ("Count", "Count"))


@_report("daily_value", "sales value per day", ("sale_date", "amount"))
def _daily_value(rows):
    out = measure_by(rows, ["sale_date"], "amount", alias="Amount")
    return _named(out, DATE, ("Amount", "Amount"))


@_report("quarter_quantity", "quantity per month, labelled by quarter", ("sale_date", "quantity"))
def _quarter_quantity(rows):
    return monthly_by_quarter(rows, "quantity", "Quantity")


@_report("quarter_value", "sales value per month, labelled by quarter", ("sale_date", "amount"))
def _quarter_value(rows):
    return monthly_by_quarter(rows, "amount", "Amount")


@_report("category_quantity", "quantity per category, zero lines dropped",
         ("sale_date", "category", "quantity"))
def _category_quantity(rows):
    out = measure_by(rows, ["category"], "quantity", "rows", "Quantity")
    return _named(out, CATEGORY, ("Quantity", "Quantity"))


@_report("subcategory_quantity", "quantity per sub-category, zero lines dropped",
         ("sale_date", "sub_category", "quantity"))
def _subcategory_quantity(rows):
    out = measure_by(rows, ["sub_category"], "quantity", "rows", "Quantity")
    return _named(out, SUBCATEGORY, ("Quantity", "Quantity"))


@_report("salesperson_quantity", "quantity per salesperson and site",
         ("source_site", "rep_id", "rep_name", "quantity", "city", "sale_date"))
def _salesperson_quantity(rows):
    out = measure_by(rows, ["source_site", "rep_id", "rep_name", "city"], "quantity", "rows", "Quantity")
    return _named(out, SITE, PERSON_ID, PERSON, CITY, ("Quantity", "Quantity"))


@_report("salesperson_value", "sales value per salesperson and site",
         ("source_site", "rep_id", "rep_name", "amount", "city", "sale_date"))
def _salesperson_value(rows):
    out = measure_by(rows, ["source_site", "rep_id", "rep_name", "city"], "amount", "rows", "Amount")
    return _named(out, SITE, PERSON_ID, PERSON, CITY, ("Amount", "Amount"))


# --- averages per day (O6) -------------------------------------------------

def named_averages(name: str, averages: DataFrame) -> DataFrame:
    """The output columns of an average report."""
    places = {"zone_avg_quantity_per_day": (CITY, STATE, ZONE), "rep_avg_quantity_per_day": (REP_ID, REP_NAME, PROMO, CATEGORY)}
    return _named(averages, POS, SITE, ("QtnPerDay", "QtnPerDay"), *places.get(name, ()))


@_report("avg_quantity_per_day", "quantity per trading day of each point of sale",
         ("pos_code", "sale_date", "source_site", "quantity"))
def _avg_quantity_per_day(rows):
    return named_averages("avg_quantity_per_day", avg_per_day(rows, (), "int"))


@_report("zone_avg_quantity_per_day", "quantity per trading day, by point of sale and place",
         ("pos_code", "sale_date", "source_site", "quantity", "city", "state", "zone"))
def _zone_avg_quantity_per_day(rows):
    return named_averages("zone_avg_quantity_per_day", avg_per_day(rows, ("city", "state", "zone"), "int"))


@_report("rep_avg_quantity_per_day", "quantity per trading day, by point of sale and rep",
         ("pos_code", "sale_date", "source_site", "quantity", *REP))
def _rep_avg_quantity_per_day(rows):
    return named_averages("rep_avg_quantity_per_day", avg_per_day(rows, REP, "float"))


# --- mobile-number completeness (O7, O8) -----------------------------------

def named_completeness(name: str, counts: DataFrame) -> DataFrame:
    """The output columns of a completeness report."""
    places = {"zone_mobile_completeness": (ZONE, STATE, CITY, SITE), "rep_mobile_completeness": (REP_ID, REP_NAME, PROMO, CATEGORY)}
    return _named(counts, *places.get(name, ()), ("CustomerMobile", "CustomerMobile"), ("Count", "Count"))


@_report("mobile_completeness", "bills with and without a usable mobile number")
def _mobile_completeness(rows):
    return named_completeness("mobile_completeness", mobile_completeness(rows, ()))


@_report("zone_mobile_completeness", "bills with and without a usable mobile number, by place")
def _zone_mobile_completeness(rows):
    return named_completeness("zone_mobile_completeness", mobile_completeness(rows, GEO))


@_report("rep_mobile_completeness", "bills with and without a usable mobile number, by rep")
def _rep_mobile_completeness(rows):
    return named_completeness("rep_mobile_completeness", mobile_completeness(rows, REP))


@_report("daily_category_scorecard", "per day and (sub-)category: quantity, value, mobile captured",
         reads=("quantity", "amount"))
def _daily_category_scorecard(rows):
    return daily_category_scorecard(rows)


# --- point-of-sale target (O11) --------------------------------------------

@_report("pos_target", "target totals per site and target",
         ("source_site", "pos_target", "field_28", "sale_date"))
def _pos_target(rows):
    out = pos_target_sum(rows, "TargetSum")
    return _named(out, SITE, ("pos_target", "PosTarget"), ("TargetSum", "TargetSum"))


# --- item rankings (O9) ----------------------------------------------------

@_report("item_ranking", "items by number of sale lines",
         ("sale_date", "sub_category", "item_code", "item_attr"))
def _item_ranking(rows):
    out = top_items(rows)
    return _named(out, ("item_code", "Item_Code"), ("Quantity", "Quantity"), SUBCATEGORY)


@_report("zone_item_ranking", "items by number of sale lines, by place",
         ("sale_date", "sub_category", "item_code", "item_attr", *GEO))
def _zone_item_ranking(rows):
    out = top_items(rows, GEO)
    return _named(out, SUBCATEGORY, ("item_code", "Item_Code"), SITE, CITY, STATE, ZONE,
                  ("Quantity", "Quantity"))


# --- dimension catalogues (O10) --------------------------------------------

@_report("rep_catalog", "reps with their promotions and categories",
         ("rep_id", "rep_name", "promo_name", "category", "sale_date"))
def _rep_catalog(rows):
    out = dimension_catalog(rows, REP)
    return _named(out, REP_ID, REP_NAME, PROMO, CATEGORY)


@_report("site_catalog", "zone / state / city / site combinations", year_rule=False)
def _site_catalog(rows):
    out = dimension_catalog(rows, ("zone", "state", "city", "source_site"))
    return _named(out, ZONE, STATE, CITY, SITE)


@_report("site_category_catalog", "sites with their categories",
         ("zone", "state", "city", "source_site", "category"), year_rule=False)
def _site_category_catalog(rows):
    out = dimension_catalog(rows, ("zone", "state", "city", "source_site", "category"))
    return _named(out, ZONE, STATE, CITY, SITE, CATEGORY)


@_report("site_promo_catalog", "sites with their promotions", ("promo_name",), year_rule=False)
def _site_promo_catalog(rows):
    out = dimension_catalog(rows, ("zone", "state", "city", "source_site", "promo_name"))
    return _named(out, ZONE, STATE, CITY, SITE, PROMO)


@_report("site_rep_catalog", "sites with their reps")
def _site_rep_catalog(rows):
    out = dimension_catalog(rows, ("zone", "state", "city", "source_site", "rep_id", "rep_name"))
    return _named(out, ZONE, STATE, CITY, SITE, REP_ID, REP_NAME)


# --- sums by place (O4) ----------------------------------------------------

@_report("zone_daily_quantity", "quantity per day and place", ("sale_date", "quantity", *GEO))
def _zone_daily_quantity(rows):
    out = measure_by(rows, ["sale_date", *GEO], "quantity", alias="Count")
    return _named(out, DATE, SITE, CITY, STATE, ZONE, ("Count", "Count"))


@_report("zone_daily_value", "sales value per day and place", ("sale_date", "amount", *GEO))
def _zone_daily_value(rows):
    out = measure_by(rows, ["sale_date", *GEO], "amount", alias="Amount")
    return _named(out, DATE, SITE, CITY, STATE, ZONE, ("Amount", "Amount"))


@_report("zone_category_quantity", "quantity per category and place",
         ("sale_date", "category", "quantity", *GEO))
def _zone_category_quantity(rows):
    out = measure_by(rows, ["category", *GEO], "quantity", "rows", "Quantity")
    return _named(out, CATEGORY, SITE, CITY, STATE, ZONE, ("Quantity", "Quantity"))


@_report("zone_subcategory_quantity", "sales value (amount) per sub-category and place",
         ("sale_date", "sub_category", "amount", *GEO))
def _zone_subcategory_quantity(rows):
    # The source report of this name sums the amount field, not quantity.
    out = measure_by(rows, ["sub_category", *GEO], "amount", "rows", "Quantity")
    return _named(out, SUBCATEGORY, SITE, CITY, STATE, ZONE, ("Quantity", "Quantity"))


@_report("zone_salesperson_quantity", "quantity per salesperson and place",
         ("source_site", "rep_id", "rep_name", "quantity", "city", "sale_date", "state", "zone"))
def _zone_salesperson_quantity(rows):
    dims = ["source_site", "rep_id", "rep_name", "city", "state", "zone"]
    out = measure_by(rows, dims, "quantity", "rows", "Quantity")
    return _named(out, SITE, PERSON_ID, PERSON, CITY, ("Quantity", "Quantity"), STATE, ZONE)


@_report("zone_salesperson_value", "sales value per salesperson and place",
         ("source_site", "rep_id", "rep_name", "amount", "city", "sale_date", "state", "zone"))
def _zone_salesperson_value(rows):
    dims = ["source_site", "rep_id", "rep_name", "city", "state", "zone"]
    out = measure_by(rows, dims, "amount", "rows", "Amount")
    return _named(out, SITE, PERSON_ID, PERSON, CITY, ("Amount", "Amount"), STATE, ZONE)


# --- sums by rep / promotion / category (O4) -------------------------------

@_report("rep_daily_quantity", "quantity per day and rep", ("sale_date", "quantity", *REP))
def _rep_daily_quantity(rows):
    out = measure_by(rows, ["sale_date", *REP], "quantity", alias="Count")
    return _named(out, DATE, REP_ID, REP_NAME, PROMO, CATEGORY, ("Count", "Count"))


@_report("rep_daily_value", "sales value per day and rep, zero totals dropped",
         ("sale_date", "amount", *REP))
def _rep_daily_value(rows):
    out = measure_by(rows, ["sale_date", *REP], "amount", "groups", "Amount")
    return _named(out, DATE, REP_ID, REP_NAME, CATEGORY, PROMO, ("Amount", "Amount"))


@_report("rep_contribution_value", "sales value per site, rep, promotion, category and city",
         ("source_site", "rep_id", "rep_name", "amount", "sale_date", "promo_name", "category", "city"))
def _rep_contribution_value(rows):
    dims = ["source_site", "rep_id", "rep_name", "promo_name", "category", "city"]
    out = measure_by(rows, dims, "amount", "rows", "Amount")
    return _named(out, SITE, REP_ID, PERSON, PROMO, CATEGORY, CITY, ("Amount", "Amount"))


@_report("rep_contribution_quantity", "quantity per site, rep, promotion, category and city",
         ("source_site", "rep_id", "rep_name", "quantity", "sale_date", "promo_name", "category", "city"))
def _rep_contribution_quantity(rows):
    dims = ["source_site", "rep_id", "rep_name", "promo_name", "category", "city"]
    out = measure_by(rows, dims, "quantity", "rows", "Quantity")
    return _named(out, SITE, PERSON_ID, PERSON, PROMO, CATEGORY, CITY, ("Quantity", "Quantity"))


@_report("rep_category_quantity", "quantity per category and rep",
         ("sale_date", "category", "quantity", "rep_id", "rep_name", "promo_name"))
def _rep_category_quantity(rows):
    out = measure_by(rows, ["category", "rep_id", "rep_name", "promo_name"], "quantity", "rows", "Quantity")
    return _named(out, CATEGORY, REP_ID, REP_NAME, PROMO, ("Quantity", "Quantity"))


@_report("rep_subcategory_quantity", "field-19 measure per sub-category and rep",
         ("sale_date", "category", "measure_19", "rep_id", "rep_name", "promo_name", "sub_category"))
def _rep_subcategory_quantity(rows):
    # The source report of this name sums field 19, not quantity.
    dims = ["category", "rep_id", "rep_name", "promo_name", "sub_category"]
    out = measure_by(rows, dims, "measure_19", "rows", "Quantity")
    return _named(out, CATEGORY, REP_ID, REP_NAME, PROMO, SUBCATEGORY, ("Quantity", "Quantity"))


def report_names() -> list[str]:
    return list(REPORTS)


def run_report(name: str, sales: DataFrame, excluded_year: str = DEFAULT_EXCLUDED_YEAR) -> DataFrame:
    return REPORTS[name].run(sales, excluded_year)
