"""DuckDB SQL for every report, to check the DataFrame code against.

The sale lines are derived by the same definition on both sides, by the same hand, so
this checks the engine's plans and not the definition itself.

Each statement runs in DuckDB over the star-schema tables (lineitem, orders,
customer, part, supplier, nation, region registered as views). It first derives
the sale lines with the same definition the Spark side uses (FIXTURES.md §3),
then computes the report in plain SQL. Used as the correctness oracle.
"""

from __future__ import annotations

# The sale lines, DuckDB dialect.
SALES_CTE = """
with sales as (
  select cast(s.s_suppkey * 10 + l.l_linenumber % 3 as varchar) as pos_code,
    strftime(o.o_orderdate, '%d-%m-%Y') as sale_date,
    cast(o.o_orderkey as varchar) as bill_no,
    s.s_name as source_site,
    case when c.c_custkey % 6 = 0 then ''
         else lpad(cast(c.c_custkey as varchar), cast(8 + c.c_custkey % 6 as int), '9') end
      as customer_mobile,
    cast(o.o_custkey % 37 as varchar) as rep_id,
    concat('Rep-', cast(o.o_custkey % 37 as varchar)) as rep_name,
    case when o.o_orderpriority = '4-NOT SPECIFIED' then '' else o.o_orderpriority end as promo_name,
    case when p.p_partkey % 97 = 0 then 'GIVEAWAY' else p.p_type end as category,
    case when p.p_partkey % 97 = 0 then 'GIVEAWAY' else p.p_brand end as sub_category,
    cast(p.p_partkey as varchar) as item_code,
    l.l_returnflag as item_attr,
    cast(case when p.p_partkey % 97 = 0 or o.o_custkey % 37 = 36 then 0
              when o.o_custkey % 37 = 35 then 1 - 2 * (l.l_linenumber % 2)
              when l.l_linenumber = 7 and l.l_returnflag = 'R' then 0
              else floor(l.l_quantity) end as bigint) as quantity,
    cast(case when p.p_partkey % 97 = 0 or o.o_custkey % 37 = 36 then 0
              when o.o_custkey % 37 = 35 then 100 - 200 * (l.l_linenumber % 2)
              else floor(l.l_extendedprice) end as bigint) as amount,
    cast(case when p.p_partkey % 97 = 0 or o.o_custkey % 37 = 36 then 0
              when o.o_custkey % 37 = 35 then 90 - 180 * (l.l_linenumber % 2)
              else floor(l.l_extendedprice * (1 - l.l_discount)) end as bigint) as measure_19,
    concat(n.n_name, '-', cast(s.s_suppkey % 3 as varchar)) as city,
    n.n_name as state,
    r.r_name as zone,
    cast(floor(s.s_acctbal) as bigint) as pos_target,
    cast(p.p_size as varchar) as field_28
  from lineitem l
    join orders o on l.l_orderkey = o.o_orderkey
    join customer c on o.o_custkey = c.c_custkey
    join part p on l.l_partkey = p.p_partkey
    join supplier s on l.l_suppkey = s.s_suppkey
    join nation n on s.s_nationkey = n.n_nationkey
    join region r on n.n_regionkey = r.r_regionkey
)
"""

DAY = "cast(strptime(sale_date, '%d-%m-%Y') as date)"
FILLED = "length(customer_mobile) in (10, 11, 12)"


def _year(y: str) -> str:
    return f"substring(sale_date, 7, 4) <> '{y}'"


def _bodies(y: str) -> dict[str, str]:
    year = _year(y)
    geo_ne = "source_site <> '' and city <> '' and state <> '' and zone <> ''"
    rep_ne = "rep_id <> '' and rep_name <> '' and promo_name <> '' and category <> ''"
    return {
        "daily_quantity": f"""
select {DAY} as date, cast(sum(quantity) as bigint) as "Count"
from sales where sale_date <> '' and quantity is not null and {year}
group by sale_date""",
        "daily_value": f"""
select {DAY} as date, cast(sum(amount) as bigint) as "Amount"
from sales where sale_date <> '' and amount is not null and {year}
group by sale_date""",
        "quarter_quantity": f"""
select case when m > 9 then 'Qtr4' when m > 6 then 'Qtr3' when m > 3 then 'Qtr2' else 'Qtr1' end
         as "Quarter",
       cast(t as varchar) as "Quantity"
from (select cast(substring(sale_date, 4, 2) as int) as m, cast(sum(quantity) as bigint) as t
      from sales where sale_date <> '' and quantity is not null and {year}
      group by substring(sale_date, 4, 2))""",
        "quarter_value": f"""
select case when m > 9 then 'Qtr4' when m > 6 then 'Qtr3' when m > 3 then 'Qtr2' else 'Qtr1' end
         as "Quarter",
       cast(t as varchar) as "Amount"
from (select cast(substring(sale_date, 4, 2) as int) as m, cast(sum(amount) as bigint) as t
      from sales where sale_date <> '' and amount is not null and {year}
      group by substring(sale_date, 4, 2))""",
        "category_quantity": f"""
select category as "Category", cast(sum(quantity) as bigint) as "Quantity"
from sales
where sale_date <> '' and category <> '' and quantity is not null and quantity <> 0 and {year}
group by category""",
        "subcategory_quantity": f"""
select sub_category as "SubCategory", cast(sum(quantity) as bigint) as "Quantity"
from sales
where sale_date <> '' and sub_category <> '' and quantity is not null and quantity <> 0 and {year}
group by sub_category""",
        "salesperson_quantity": f"""
select source_site as "SourceSite", rep_id as "SalespersonId", rep_name as "Salesperson",
       city as "City", cast(sum(quantity) as bigint) as "Quantity"
from sales
where source_site <> '' and rep_id <> '' and rep_name <> '' and city <> '' and sale_date <> ''
  and quantity is not null and quantity <> 0 and {year}
group by source_site, rep_id, rep_name, city""",
        "salesperson_value": f"""
select source_site as "SourceSite", rep_id as "SalespersonId", rep_name as "Salesperson",
       city as "City", cast(sum(amount) as bigint) as "Amount"
from sales
where source_site <> '' and rep_id <> '' and rep_name <> '' and city <> '' and sale_date <> ''
  and amount is not null and amount <> 0 and {year}
group by source_site, rep_id, rep_name, city""",
        "avg_quantity_per_day": f"""
select pos_code as "PosCode", source_site as "SourceSite",
       cast(trunc(sum(quantity) / count(distinct sale_date)) as bigint) as "QtnPerDay"
from sales
where pos_code <> '' and sale_date <> '' and source_site <> '' and quantity is not null and {year}
group by pos_code, source_site""",
        "zone_avg_quantity_per_day": f"""
with kept as (
  select * from sales
  where pos_code <> '' and sale_date <> '' and quantity is not null and {geo_ne} and {year}),
days as (select pos_code, source_site, count(distinct sale_date) as d from kept
         group by pos_code, source_site),
tot as (select pos_code, source_site, city, state, zone, sum(quantity) as q from kept
        group by pos_code, source_site, city, state, zone)
select t.pos_code as "PosCode", t.source_site as "SourceSite",
       cast(trunc(t.q / d.d) as bigint) as "QtnPerDay",
       t.city as "City", t.state as "State", t.zone as "Zone"
from tot t join days d on t.pos_code = d.pos_code and t.source_site = d.source_site""",
        "rep_avg_quantity_per_day": f"""
with kept as (
  select * from sales
  where pos_code <> '' and sale_date <> '' and source_site <> '' and quantity is not null
    and {rep_ne} and {year}),
days as (select pos_code, source_site, count(distinct sale_date) as d from kept
         group by pos_code, source_site),
tot as (select pos_code, source_site, rep_id, rep_name, promo_name, category, sum(quantity) as q
        from kept group by pos_code, source_site, rep_id, rep_name, promo_name, category)
select t.pos_code as "PosCode", t.source_site as "SourceSite",
       cast(cast(cast(t.q as float) as double) / cast(cast(d.d as float) as double) as float)
         as "QtnPerDay",
       t.rep_id as "SalesRepNameid", t.rep_name as "SalesRepName",
       t.promo_name as "PromoName", t.category as "Category"
from tot t join days d on t.pos_code = d.pos_code and t.source_site = d.source_site""",
        "mobile_completeness": f"""
select case when {FILLED} then 'Yes' else 'No' end as "CustomerMobile", count(*) as "Count"
from (select distinct bill_no, customer_mobile from sales where {year})
group by 1""",
        "zone_mobile_completeness": f"""
select zone as "Zone", state as "State", city as "City", source_site as "SourceSite",
       case when {FILLED} then 'Yes' else 'No' end as "CustomerMobile", count(*) as "Count"
from (select distinct bill_no, source_site, city, state, zone, customer_mobile
      from sales where {year})
group by zone, state, city, source_site, 5""",
        "rep_mobile_completeness": f"""
select rep_id as "SalesRepNameid", rep_name as "SalesRepName", promo_name as "PromoName",
       category as "Category",
       case when {FILLED} then 'Yes' else 'No' end as "CustomerMobile", count(*) as "Count"
from (select distinct bill_no, rep_id, rep_name, promo_name, category, customer_mobile
      from sales where {year})
group by rep_id, rep_name, promo_name, category, 5""",
        "daily_category_scorecard": f"""
with kept as (select * from sales where {year}),
q as (select sale_date, category, sub_category, sum(quantity) as qty from kept
      group by sale_date, category, sub_category),
a as (select sale_date, category, sub_category, sum(amount) as amt from kept
      group by sale_date, category, sub_category),
m as (select sale_date, category, sub_category,
             case when sum(f) >= 1 then 'Yes' else 'No' end as mob
      from (select distinct sale_date, category, sub_category, bill_no,
                   case when {FILLED} then 1 else 0 end as f
            from kept)
      group by sale_date, category, sub_category)
select cast(strptime(q.sale_date, '%d-%m-%Y') as date) as date, q.category as "Category",
       q.sub_category as "SubCategory", cast(cast(q.qty as bigint) as varchar) as "Quantity",
       cast(cast(a.amt as bigint) as varchar) as "Amount", m.mob as "CustomerMobile",
       '1' as "Count"
from q join a using (sale_date, category, sub_category)
       join m using (sale_date, category, sub_category)""",
        "pos_target": f"""
select source_site as "SourceSite", pos_target as "PosTarget",
       cast(sum(pos_target) as bigint) as "TargetSum"
from sales
where source_site <> '' and pos_target is not null and field_28 <> '' and sale_date <> '' and {year}
group by source_site, pos_target""",
        "item_ranking": f"""
select item_code as "Item_Code", count(*) as "Quantity", sub_category as "SubCategory"
from sales
where sale_date <> '' and sub_category <> '' and item_code <> '' and item_attr <> '' and {year}
group by sub_category, item_code, item_attr""",
        "zone_item_ranking": f"""
select sub_category as "SubCategory", item_code as "Item_Code", source_site as "SourceSite",
       city as "City", state as "State", zone as "Zone", count(*) as "Quantity"
from sales
where sale_date <> '' and sub_category <> '' and item_code <> '' and item_attr <> ''
  and {geo_ne} and {year}
group by sub_category, item_code, item_attr, source_site, city, state, zone""",
        "rep_catalog": f"""
select distinct rep_id as "SalesRepNameid", rep_name as "SalesRepName",
       promo_name as "PromoName", category as "Category"
from sales where {rep_ne} and sale_date <> '' and {year}""",
        "site_catalog": """
select distinct zone as "Zone", state as "State", city as "City", source_site as "SourceSite"
from sales""",
        "site_category_catalog": """
select distinct zone as "Zone", state as "State", city as "City", source_site as "SourceSite",
       category as "Category"
from sales
where zone <> '' and state <> '' and city <> '' and source_site <> '' and category <> ''""",
        "site_promo_catalog": """
select * from (
  select distinct zone as "Zone", state as "State", city as "City", source_site as "SourceSite",
         promo_name as "PromoName"
  from sales)
where "PromoName" <> ''""",
        "site_rep_catalog": f"""
select distinct zone as "Zone", state as "State", city as "City", source_site as "SourceSite",
       rep_id as "SalesRepNameid", rep_name as "SalesRepName"
from sales where {year}""",
        "zone_daily_quantity": f"""
select {DAY} as date, source_site as "SourceSite", city as "City", state as "State",
       zone as "Zone", cast(sum(quantity) as bigint) as "Count"
from sales where sale_date <> '' and quantity is not null and {geo_ne} and {year}
group by sale_date, source_site, city, state, zone""",
        "zone_daily_value": f"""
select {DAY} as date, source_site as "SourceSite", city as "City", state as "State",
       zone as "Zone", cast(sum(amount) as bigint) as "Amount"
from sales where sale_date <> '' and amount is not null and {geo_ne} and {year}
group by sale_date, source_site, city, state, zone""",
        "zone_category_quantity": f"""
select category as "Category", source_site as "SourceSite", city as "City", state as "State",
       zone as "Zone", cast(sum(quantity) as bigint) as "Quantity"
from sales
where sale_date <> '' and category <> '' and quantity is not null and quantity <> 0
  and {geo_ne} and {year}
group by category, source_site, city, state, zone""",
        "zone_subcategory_quantity": f"""
select sub_category as "SubCategory", source_site as "SourceSite", city as "City",
       state as "State", zone as "Zone", cast(sum(amount) as bigint) as "Quantity"
from sales
where sale_date <> '' and sub_category <> '' and amount is not null and amount <> 0
  and {geo_ne} and {year}
group by sub_category, source_site, city, state, zone""",
        "zone_salesperson_quantity": f"""
select source_site as "SourceSite", rep_id as "SalespersonId", rep_name as "Salesperson",
       city as "City", cast(sum(quantity) as bigint) as "Quantity", state as "State", zone as "Zone"
from sales
where rep_id <> '' and rep_name <> '' and sale_date <> '' and quantity is not null
  and quantity <> 0 and {geo_ne} and {year}
group by source_site, rep_id, rep_name, city, state, zone""",
        "zone_salesperson_value": f"""
select source_site as "SourceSite", rep_id as "SalespersonId", rep_name as "Salesperson",
       city as "City", cast(sum(amount) as bigint) as "Amount", state as "State", zone as "Zone"
from sales
where rep_id <> '' and rep_name <> '' and sale_date <> '' and amount is not null
  and amount <> 0 and {geo_ne} and {year}
group by source_site, rep_id, rep_name, city, state, zone""",
        "rep_daily_quantity": f"""
select {DAY} as date, rep_id as "SalesRepNameid", rep_name as "SalesRepName",
       promo_name as "PromoName", category as "Category", cast(sum(quantity) as bigint) as "Count"
from sales where sale_date <> '' and quantity is not null and {rep_ne} and {year}
group by sale_date, rep_id, rep_name, promo_name, category""",
        "rep_daily_value": f"""
select * from (
  select {DAY} as date, rep_id as "SalesRepNameid", rep_name as "SalesRepName",
         category as "Category", promo_name as "PromoName", cast(sum(amount) as bigint) as "Amount"
  from sales where sale_date <> '' and amount is not null and {rep_ne} and {year}
  group by sale_date, rep_id, rep_name, promo_name, category)
where "Amount" <> 0""",
        "rep_contribution_value": f"""
select source_site as "SourceSite", rep_id as "SalesRepNameid", rep_name as "Salesperson",
       promo_name as "PromoName", category as "Category", city as "City",
       cast(sum(amount) as bigint) as "Amount"
from sales
where source_site <> '' and city <> '' and sale_date <> '' and amount is not null and amount <> 0
  and {rep_ne} and {year}
group by source_site, rep_id, rep_name, promo_name, category, city""",
        "rep_contribution_quantity": f"""
select source_site as "SourceSite", rep_id as "SalespersonId", rep_name as "Salesperson",
       promo_name as "PromoName", category as "Category", city as "City",
       cast(sum(quantity) as bigint) as "Quantity"
from sales
where source_site <> '' and city <> '' and sale_date <> '' and quantity is not null
  and quantity <> 0 and {rep_ne} and {year}
group by source_site, rep_id, rep_name, promo_name, category, city""",
        "rep_category_quantity": f"""
select category as "Category", rep_id as "SalesRepNameid", rep_name as "SalesRepName",
       promo_name as "PromoName", cast(sum(quantity) as bigint) as "Quantity"
from sales
where sale_date <> '' and quantity is not null and quantity <> 0 and {rep_ne} and {year}
group by category, rep_id, rep_name, promo_name""",
        "rep_subcategory_quantity": f"""
select category as "Category", rep_id as "SalesRepNameid", rep_name as "SalesRepName",
       promo_name as "PromoName", sub_category as "SubCategory",
       cast(sum(measure_19) as bigint) as "Quantity"
from sales
where sale_date <> '' and measure_19 is not null and measure_19 <> 0 and sub_category <> ''
  and {rep_ne} and {year}
group by category, rep_id, rep_name, promo_name, sub_category""",
    }


def oracle_statements(excluded_year: str) -> dict[str, str]:
    """Complete DuckDB statements, one per report name."""
    out = {}
    for name, body in _bodies(excluded_year).items():
        text = body.lstrip()
        if text.startswith("with "):
            # The report's own CTEs continue the shared WITH list.
            out[name] = SALES_CTE + ", " + text[len("with "):]
        else:
            out[name] = SALES_CTE + text
    return out


_DAY = "cast(strptime(sale_date, '%d-%m-%Y') as date)"


def analysis_statements() -> dict[str, str]:
    """DuckDB statements of the queries beyond the reports."""
    lines = "select bill_no, item_code, pos_code, source_site, quantity, " + _DAY + " as sale_day from sales"
    runs = [oracle_statements(year)["zone_category_quantity"] for year in ("1998", "1999")]
    return {
        "reconciled_runs": f"""
select "Category", "SourceSite", "City", "State", "Zone", "Quantity",
  count(*) filter (run = 1) as left_rows, count(*) filter (run = 2) as right_rows
from (select *, 1 as run from ({runs[0]}) union all select *, 2 as run from ({runs[1]}))
group by "Category", "SourceSite", "City", "State", "Zone", "Quantity"
having count(*) filter (run = 1) <> count(*) filter (run = 2)""",
        "sketched_zones": SALES_CTE + """
select zone, count(distinct bill_no) as bills, true as bills_within_bound, count(amount) as lines, true as median_within_bound
from sales group by zone""",
        "top_items_by_site": SALES_CTE + """, counted as (
  select source_site, city, state, zone, sub_category, item_code, item_attr, count(*) as n from sales group by all)
select source_site, city, state, zone, cast(place as int) as rank, sub_category, item_code, item_attr, n as "Quantity" from (
  select *, row_number() over (partition by source_site, city, state, zone
    order by n desc, sub_category, item_code, item_attr) as place from counted)
where place <= 10""",
        "top_items_by_zone": SALES_CTE + """, counted as (
  select zone, sub_category, item_code, item_attr, count(*) as n from sales group by all)
select zone, cast(place as int) as rank, sub_category, item_code, item_attr, n as "Quantity" from (
  select *, rank() over (partition by zone order by n desc) as place from counted)
where place <= 3""",
        "unit_price_in_force": SALES_CTE + f""", prices as (
  select cast(l_partkey as varchar) as item_code, cast(l_shipdate as date) as price_day,
    max(cast(floor(l_extendedprice / l_quantity) as bigint)) as unit_price
  from lineitem group by all),
lines as ({lines})
select l.bill_no, l.item_code, l.pos_code, l.quantity, l.sale_day, p.price_day, p.unit_price
from lines l asof left join prices p on l.item_code = p.item_code and l.sale_day >= p.price_day""",
        "sales_in_campaigns": SALES_CTE + f""", periods as (
  select s_name as source_site, k as campaign,
    cast(date '1995-01-01' + cast((s_suppkey * 131 + k * 700) % 2400 as int) as date) as first_day, s_suppkey, days
  from supplier, (values (0, 20), (1, 200), (2, 900)) as c(k, days)),
held as (select source_site, campaign, first_day, cast(first_day + cast(days + s_suppkey % 50 as int) as date) as last_day from periods),
lines as ({lines})
select l.*, cast(h.campaign as int) as campaign, h.first_day, h.last_day
from lines l join held h on l.source_site = h.source_site and l.sale_day between h.first_day and h.last_day""",
        "event_windows": """
select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as window_start,
  strftime(date_trunc('hour', ts) + interval 1 hour, '%Y-%m-%d %H:%M:%S') as window_end,
  event_type, count(*) as events, cast(coalesce(sum(cast(round(value * 100) as bigint)), 0) as bigint) as cents
from events where ts is not null group by date_trunc('hour', ts), event_type""",
        "user_sessions": """
with e as (select *, coalesce(ts - lag(ts) over (partition by user_id order by ts) >= interval 30 minutes, true) as opens
  from events where ts is not null),
s as (select *, sum(case when opens then 1 else 0 end) over (partition by user_id order by ts rows unbounded preceding) as k from e)
select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as session_start,
  strftime(max(ts) + interval 30 minutes, '%Y-%m-%d %H:%M:%S.%f') as session_end,
  count(*) as events, cast(coalesce(sum(cast(round(value * 100) as bigint)), 0) as bigint) as cents
from s group by user_id, k""",
    }
