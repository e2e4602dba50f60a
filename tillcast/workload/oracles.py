"""SQL for each registered query, run by DuckDB on the same tables."""

from __future__ import annotations

import re

from tillcast.sources.cities import CITIES, PROFILES
from tillcast.workload.registry import ANCHOR, NOW
from tillcast.workload.standins import SEEDED_AT


def half_up(numerator: str, denominator: str) -> str:
    """Quotient of two non-negative integers, rounded half up, as an integer."""
    n, d = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)"
    return f"((2 * {n} + {d}) // nullif(2 * {d}, 0))"


def cents(amount: str) -> str:
    return f"cast({amount} * 100 as hugeint)"


def scaled(integer: str, places: int, type_: str) -> str:
    unit = "0." + "0" * (places - 1) + "1"
    return f"cast(cast({integer} as decimal({38 - places - 1},0)) * cast('{unit}' as decimal({places + 1},{places})) as {type_})"


def ratio_2dp(total: str, count: str) -> str:
    return scaled(half_up(cents(total), count), 2, "decimal(20,2)")


def share_pct(part: str, whole: str) -> str:
    return scaled(half_up(f"{cents(part)} * 10000", cents(whole)), 2, "decimal(7,2)")


def local(instant: str, zone: str) -> str:
    return f"(({instant} at time zone 'UTC') at time zone {zone})"


def utc(wall: str, zone: str) -> str:
    return f"(({wall} at time zone {zone}) at time zone 'UTC')"


def date_key(day: str) -> str:
    return f"cast(strftime({day}, '%Y%m%d') as integer)"


_ZONES = ",\n".join(
    f"({n}, '{zone}', cast('{factor}' as decimal(5,2)), cast('{lat}' as decimal(9,5)), cast('{lon}' as decimal(9,5)))"
    for n, ((_, lat, lon), (_, zone, factor)) in enumerate(zip(CITIES, PROFILES))
)

SYNTHETIC_COLUMNS = """source_sale_id, synthetic_sale_id, synthetic_sale_item_id, city_slug, timezone,
    date, sold_at, product_name, payment_type, amount_money, price_multiplier, amount_rub,
    quantity, line_number, is_synthetic"""


def fan_out(log: str, cities: str) -> str:
    """Sales of a log in every city."""
    return f"""
    select s.*, sha256(synthetic_sale_id || '|1') as synthetic_sale_item_id
    from (
      select source_sale_id, sha256(source_sale_id || '|' || city_slug) as synthetic_sale_id, city_slug, timezone,
        date, {utc("cast(date::varchar || ' ' || time as timestamp)", "timezone")} as sold_at,
        coffee_name as product_name, cash_type as payment_type, money as amount_money,
        multiplier as price_multiplier, cast(money * 10 * multiplier as decimal(12,2)) as amount_rub,
        1 as quantity, 1 as line_number, true as is_synthetic
      from (
        select *, sha256(concat_ws('|', date::varchar, time, coffee_name, money::varchar, cash_type)) as source_sale_id
        from {log}
      ) cross join {cities}
    ) s"""


def calendar(start: str, end: str, source: str) -> str:
    return f"""
    select {date_key('date')} as date_key, date, cast(year(date) as integer) as year,
      cast(month(date) as integer) as month, dayname(date) as weekday, isodow(date) in (6, 7) as is_weekend
    from (select cast(unnest(generate_series({start}, {end}, interval 1 day)) as date) as date
          from (select min(ts)::date as a, max(ts)::date as b from {source}))"""


CTES = {
    "zones": f"select * from (values {_ZONES}) as v(i, timezone, multiplier, latitude, longitude)",
    "city": """
    select n_nationkey as city_no, replace(replace(lower(n_name), ' ', '_'), '-', '_') as city_slug,
      n_name as city_name, timezone, multiplier, latitude, longitude,
      md5(replace(replace(lower(n_name), ' ', '_'), '-', '_')) as city_key
    from nation join zones on n_nationkey % 20 = i""",
    "city_known": """
    select city_slug, case when city_no < 20 then timezone end as timezone,
      case when city_no < 20 then multiplier end as multiplier from city""",
    "ev": "select *, cast(json_extract_string(props, '$.k') as integer) as k from events",
    "placed": "select ev.*, city.* from ev join city on user_id % 25 = city_no",
    "named": """
    select ev.*, case when k < 50 then p_name else p_name || ' ' end as coffee_name
    from ev left join part on p_partkey = k""",
    "log": """
    select hour(ts)::integer as hour_of_day, case when k < 50 then 'card' else 'cash' end as cash_type,
      cast(value as decimal(12,2)) as money, coffee_name,
      case when hour(ts) < 12 then 'Morning' when hour(ts) < 17 then 'Afternoon' else 'Night' end as time_of_day,
      strftime(ts, '%a') as weekday, strftime(ts, '%b') as month_name, isodow(ts)::integer as weekdaysort,
      month(ts)::integer as monthsort, ts::date as date, strftime(ts, '%H:%M:%S.%g') as time
    from named""",
    "coarse_log": """
    select event_type as cash_type, cast(k as decimal(12,2)) as money, coffee_name, ts::date as date,
      strftime(ts, '%H:00:00.000') as time from named""",
    "synthetic": fan_out("log", "city"),
    "coarse": fan_out("coarse_log", "city_known"),
    "event_days": calendar("a - 1", "b + 1", "events"),
    "ahead_days": calendar("a - 1", "b + 4", "events"),
    "order_days": calendar("a", "b", "(select o_orderdate as ts from orders)"),
    "fct": f"""
    select synthetic_sale_id as sale_key, cast(hour({local('sold_at', 'timezone')}) as integer) as hour,
      amount_rub as total_amount_rub, source_sale_id, md5(city_slug) as city_key, sold_at, date_key,
      payment_type, is_synthetic
    from synthetic left join event_days using (date)""",
    "loads": """
    select city_slug, city_key, timezone, ts::date as period_start, ts::date as period_end, ts as loaded_at,
      date_trunc('hour', ts) as measured_at,
      cast(case when event_type <> 'error' then value end as decimal(12,5)) as precipitation_mm,
      cast(case when event_type <> 'signup' then value end as decimal(6,2)) as temperature_c,
      cast(k + 900 as decimal(8,2)) as surface_pressure_hpa, cast(k as decimal(6,2)) as apparent_temperature_c
    from placed""",
    "weather": f"""
    select city_key, measured_at, date_key, cast(hour({local('measured_at', 'timezone')}) as integer) as hour,
      temperature_c, apparent_temperature_c, precipitation_mm, surface_pressure_hpa, loaded_at
    from (select *, row_number() over (partition by city_slug, measured_at
            order by loaded_at desc, period_end desc, period_start desc) as n from loads)
    left join event_days on date = cast({local('measured_at', 'timezone')} as date)
    where n = 1""",
    "forecast": f"""
    select city_key, issued_at, forecast_for, forecast_days, date_key as forecast_date_key,
      cast(hour({local('forecast_for', 'timezone')}) as integer) as forecast_hour, temperature_c,
      apparent_temperature_c, precipitation_mm, surface_pressure_hpa, precipitation_probability_pct, loaded_at
    from (select city_key, timezone, date_trunc('hour', ts) as issued_at,
            date_trunc('hour', ts) + to_hours(k % 48) as forecast_for, 3 as forecast_days,
            cast(value as decimal(6,2)) as temperature_c, cast(k as decimal(6,2)) as apparent_temperature_c,
            cast(cast(value as decimal(12,5)) - 1 as decimal(12,5)) as precipitation_mm,
            cast(k as decimal(8,2)) as surface_pressure_hpa,
            cast(k + 5 as decimal(6,2)) as precipitation_probability_pct, ts as loaded_at
          from placed)
    left join ahead_days on date = cast({local('forecast_for', 'timezone')} as date)""",
    "hour_cells": """
    select user_id, city_slug, latitude, longitude, ts::date as day, date_trunc('hour', ts) as hour,
      max(cast(value as decimal(6,2))) as temperature, min(cast(value as decimal(12,5))) as rain, max(k) as k,
      max(ts) as newest
    from placed group by all""",
    "cells": """
    select *, max(newest) over (partition by user_id, day) as loaded_at,
      row_number() over (partition by user_id, day order by hour) as n,
      count(*) over (partition by user_id, day) as hours
    from hour_cells""",
    "documents": """
    select user_id, city_slug, latitude, longitude, day as period_start, hours::integer as hours
    from cells where n = 1""",
    "products": "select distinct trim(p_name) as product_name, md5(trim(p_name)) as product_key from part",
    "items": f"""
    select sha256(l_orderkey::varchar || '|' || l_linenumber::varchar) as sale_item_key,
      l_orderkey::varchar as sale_key, l_linenumber as line_number, product_key, quantity,
      {ratio_2dp('amount', 'quantity')} as unit_price_rub, amount as line_amount_rub
    from (select *, cast(l_quantity as integer) as quantity, cast(l_extendedprice as decimal(12,2)) as amount
          from lineitem)
    left join part on p_partkey = l_partkey left join products on product_name = trim(p_name)""",
    "receipts": f"""
    select o_orderkey::varchar as sale_key, city_key, {date_key('o_orderdate')} as date_key,
      hour(o_orderdate)::integer as hour, cast(o_totalprice as decimal(12,2)) as total_amount_rub
    from orders join customer on c_custkey = o_custkey join city on city_no = c_nationkey""",
    "settled": """
    select r.* replace (case when sale_key::bigint % 10 = 0 then total_amount_rub else s.amount end as total_amount_rub)
    from receipts r left join (select sale_key, cast(sum(line_amount_rub) as decimal(12,2)) as amount from items group by all) s
      using (sale_key)""",
    "sold": "select items.*, city_key, date_key from items left join receipts using (sale_key)",
    "product_days": """
    select city_key, date_key, product_key, cast(sum(quantity) as bigint) as units_sold,
      count(distinct sale_key) as receipts_count, cast(sum(line_amount_rub) as decimal(20,2)) as product_revenue_rub
    from sold group by all""",
    "shares": f"""
    select p.*, {share_pct('product_revenue_rub', 'city_revenue')} as revenue_share_pct
    from product_days p left join (select city_key, date_key, sum(product_revenue_rub) as city_revenue
                                   from product_days group by all) using (city_key, date_key)""",
    "product_mart": f"""
    select city_key, city_slug, city_name, date_key, date as sales_date, product_key, product_name, units_sold,
      receipts_count, product_revenue_rub, {ratio_2dp('product_revenue_rub', 'units_sold')} as average_unit_price_rub,
      revenue_share_pct
    from shares left join city using (city_key) left join products using (product_key)
    left join order_days using (date_key)""",
    "sales_days": """
    select city_key, date_key, count(*) as sales_count, cast(sum(total_amount_rub) as decimal(20,2)) as total_revenue_rub
    from fct group by all""",
    "weather_days": """
    select city_key, date_key, sum(temperature_c)::double / nullif(count(temperature_c), 0) as avg_temperature_c,
      min(temperature_c) as min_temperature_c, max(temperature_c) as max_temperature_c,
      cast(sum(precipitation_mm) as decimal(20,5)) as total_precipitation_mm,
      count(temperature_c)::integer as temperature_hours_count,
      count(precipitation_mm)::integer as precipitation_hours_count
    from weather group by all""",
    "daily_mart": f"""
    select city_key, city_slug, city_name, date_key, date as sales_date, weekday, is_weekend, sales_count,
      total_revenue_rub, {ratio_2dp('total_revenue_rub', 'sales_count')} as average_check_rub, avg_temperature_c,
      min_temperature_c, max_temperature_c, total_precipitation_mm,
      coalesce(temperature_hours_count, 0) as temperature_hours_count,
      coalesce(precipitation_hours_count, 0) as precipitation_hours_count
    from sales_days left join weather_days using (city_key, date_key) left join city using (city_key)
    left join event_days using (date_key)""",
    "sales_hours": f"""
    select city_key, date_key, hour, count(*) as sales_count,
      cast(sum(total_amount_rub) as decimal(20,2)) as total_revenue_rub,
      {scaled(half_up(cents('sum(total_amount_rub)') + ' * cast(100000000000000 as hugeint)', 'count(total_amount_rub)'),
              16, 'decimal(38,16)')} as average_check_rub
    from fct group by all""",
    "grid": """
    select weather.* from weather
    join (select city_key, min(date_key) as a, max(date_key) as b from sales_hours group by all) using (city_key)
    where date_key between a and b""",
    "hourly_mart": """
    select city_key, date_key, hour, measured_at, temperature_c, apparent_temperature_c, precipitation_mm,
      surface_pressure_hpa, coalesce(sales_count, 0) as sales_count,
      cast(coalesce(total_revenue_rub, 0) as decimal(20,2)) as total_revenue_rub, average_check_rub, city_slug,
      city_name, date as sales_date
    from grid left join sales_hours using (city_key, date_key, hour) left join city using (city_key)
    left join event_days using (date_key)""",
    "both_sides": """
    select coalesce(s.sale_key, i.sale_key) as sale_key from settled s
    full join (select sale_key, sum(line_amount_rub) as amount from items group by all) i using (sale_key)
    where total_amount_rub is distinct from amount""",
}


def _needed(text: str) -> set[str]:
    """Names of the CTEs a query uses, directly or through others."""
    found: set[str] = set()
    queue = [text]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        new = {name for name in CTES if name in words} - found
        found |= new
        queue += [CTES[name] for name in new]
    return found


def _sql(text: str) -> str:
    # DuckDB keeps a CTE it reads twice, so nothing is computed again.
    needed = [name for name in CTES if name in _needed(text)]
    heads = ",\n".join(f"{name} as materialized ({CTES[name]})" for name in needed)
    return f"with {heads}\n{text}" if heads else text


def _full_mismatch(mart: str, rows: str) -> str:
    return f"""
    select '{mart}' as mart, coalesce(e.city_key, a.city_key) as city_key, coalesce(e.date_key, a.date_key) as date_key
    from sales_days e full join ({rows}) a using (city_key, date_key)
    where coalesce(e.sales_count, 0) <> coalesce(a.n, 0) or coalesce(e.total_revenue_rub, 0) <> coalesce(a.r, 0)"""


def _audit() -> str:
    required = [
        "source_sale_id", "synthetic_sale_id", "synthetic_sale_item_id", "city_slug", "timezone", "sold_at",
        "product_name", "amount_rub", "quantity", "line_number",
    ]
    checks = {f"null {c}": f"count(*) filter ({c} is null)" for c in required}
    checks |= {
        "amount_rub not positive": "count(*) filter (amount_rub <= 0)",
        "quantity not 1": "count(*) filter (quantity <> 1)",
        "line_number not 1": "count(*) filter (line_number <> 1)",
        "row count off": "abs(count(*) - (select count(*) from coarse_log) * (select count(*) from city))",
        "synthetic_sale_id repeated": "count(*) - count(distinct synthetic_sale_id)",
        "synthetic_sale_item_id repeated": "count(*) - count(distinct synthetic_sale_item_id)",
    }
    branches = "\nunion all ".join(
        f'select \'{name}\' as "check", {test} as n_rows from coarse' for name, test in checks.items()
    )
    return f"select * from ({branches}) where n_rows > 0"


_HOURLY = """
    select city_slug, day as period_start, day as period_end, loaded_at, hour as measured_at,
      rain as precipitation_mm, temperature as temperature_c, cast(k + 900 as decimal(8,2)) as surface_pressure_hpa,
      cast(k as decimal(6,2)) as apparent_temperature_c, latitude, longitude from cells"""

_JSON_FIELDS = ", ".join(
    f"'{name}', {value}"
    for name, value in {
        "city_key": "city_key",
        "date_key": "date_key",
        "hour": "hour",
        "measured_at": "strftime(measured_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'",
        "temperature_c": "temperature_c::varchar",
        "apparent_temperature_c": "apparent_temperature_c::varchar",
        "precipitation_mm": "precipitation_mm::varchar",
        "surface_pressure_hpa": "surface_pressure_hpa::varchar",
        "sales_count": "sales_count",
        "total_revenue_rub": "total_revenue_rub::varchar",
        "city_slug": "city_slug",
        "city_name": "city_name",
        "sales_date": "sales_date::varchar",
    }.items()
)

_WEATHER_COLUMNS = [
    "city_key", "measured_at", "date_key", "hour", "temperature_c", "apparent_temperature_c",
    "precipitation_mm", "surface_pressure_hpa", "loaded_at",
]

_CELL_LATEST = """
    select city_slug, date_trunc('hour', ts) as measured_at, cast(value as decimal(6,2)) as temperature_c,
      ts as loaded_at, event_type = 'purchase' as bought,
      bool_or(event_type = 'purchase') over (partition by city_slug, date_trunc('hour', ts)) as replaced,
      row_number() over (partition by city_slug, date_trunc('hour', ts), event_type = 'purchase' order by ts desc) as n
    from placed"""

_SEED_ROWS = ", ".join(
    f"('{name}', cast('{lat}' as decimal(9,5)), cast('{lon}' as decimal(9,5)))" for name, lat, lon in CITIES
)

_DAY_KEY = "city_key, date_key"

_RECEIPTS_AND_LATE = """
    select * from fct union all by name select * replace (20991231 as date_key,
      case when payment_type <> 'card' then payment_type end as payment_type) from fct where hour = 12"""

ORACLES = {
    # --- marts ---
    "daily_mart": "select * from daily_mart",
    "hourly_mart": "select * from hourly_mart",
    "product_mart": "select * from product_mart",
    "sales_per_day": """
        select city_key, date_key, count(*) as sales_count,
          cast(sum(total_amount_rub) as decimal(20,2)) as total_revenue_rub from receipts group by all""",
    "weather_per_day": "select * from weather_days",
    "sales_per_hour": "select * from sales_hours",
    "receipts_distinct": "select * from product_days",
    "share_of_day": "select city_key, date_key, product_key, product_revenue_rub, revenue_share_pct from shares",
    "sales_period_range_join": "select city_key, date_key, hour, measured_at, temperature_c from grid",
    "rollup_avg_check": f"""
        select *, {ratio_2dp('total_revenue_rub', 'sales_count')} as average_check_rub
        from (select city_slug, cast(sum(sales_count) as bigint) as sales_count,
                cast(sum(total_revenue_rub) as decimal(20,2)) as total_revenue_rub from daily_mart group by all)""",
    "rollup_share": f"""
        select city_key, month_key, product_key, revenue as product_revenue_rub,
          {share_pct('revenue', 'sum(revenue) over (partition by city_key, month_key)')} as revenue_share_pct
        from (select city_key, cast(date_key // 100 as integer) as month_key, product_key,
                cast(sum(product_revenue_rub) as decimal(20,2)) as revenue from product_mart group by all)""",
    "complete_days": """
        select city_key, date_key, avg_temperature_c, temperature_hours_count, sales_count
        from daily_mart where temperature_hours_count = 8""",
    "rollup_receipts": """
        select city_key, product_key, count(distinct sale_key) as receipts_count from sold group by all""",
    # Lines without a receipt have no number; a group of nothing but them isn't there.
    "receipt_bitmaps": """
        select city_key, product_key, count(distinct sale_key) as receipts_count from sold
        where sale_key in (select sale_key from receipts) group by all""",
    "receipt_bitmaps_monthly": """
        select city_key, cast(date_key // 100 as integer) as month_key, count(distinct sale_key) as receipts_count
        from sold where sale_key in (select sale_key from receipts) group by all""",
    "touched_days_refresh": "select * from daily_mart",
    "resolved_log": """
        select city_slug, period_start, period_end, loaded_at, measured_at, precipitation_mm, temperature_c,
          surface_pressure_hpa, apparent_temperature_c
        from (select *, row_number() over (partition by city_slug, measured_at order by loaded_at desc) as n from loads)
        where n = 1""",
    # --- fan-out ---
    "sales_fanout": f"select {SYNTHETIC_COLUMNS} from synthetic",
    "fanout_audit": _audit(),
    "city_profiles_join": "select city_slug, timezone, multiplier as price_multiplier from city_known",
    # --- staging ---
    "staged_sales_log": """
        select cast(date::varchar || ' ' || time as timestamp) as ordered_at, coffee_name as product_name,
          cast(money as decimal(10,2)) as transaction_amount, cash_type as payment_type,
          hour_of_day as order_hour, time_of_day as day_period, weekday as weekday_name,
          weekdaysort as weekday_number, month_name, monthsort as month_number from log""",
    "staged_cities": f"""
        select city_slug, city_name, latitude, longitude, timestamp '{SEEDED_AT}' as updated_at from city""",
    "staged_synthetic_sales": f"""
        select {SYNTHETIC_COLUMNS.replace('date,', 'date as sold_local_date,').replace('amount_money', 'amount_money as source_amount')}
        from synthetic""",
    "payload_explode": _HOURLY,
    "payload_forecast": """
        select city_slug, day::timestamp as issued_at, 3 as forecast_days, loaded_at, hour as forecast_for,
          rain as precipitation_mm, temperature as temperature_c, cast(k + 900 as decimal(8,2)) as surface_pressure_hpa,
          cast(k as decimal(6,2)) as apparent_temperature_c,
          cast(k + 5 as decimal(6,2)) as precipitation_probability_pct, latitude, longitude from cells""",
    "payload_ragged": _HOURLY.replace("rain as", "case when n < hours then rain end as").replace(
        "cast(k as decimal(6,2))", "cast(null as decimal(6,2))"
    ),
    "payload_coordinates": "select user_id, period_start, latitude, longitude from documents",
    "payload_completeness": "select user_id, city_slug, period_start, hours from documents where hours < 3",
    "load_summary": """
        select count(*) as documents, cast(sum(hours) as bigint) as total_hours,
          count(*) filter (hours < 3) as incomplete from documents""",
    # --- dimensions and facts ---
    "dim_city": """
        select city_key, city_slug, city_name, s.timezone, latitude, longitude
        from city left join (select distinct city_slug, timezone from synthetic) s using (city_slug)""",
    "dim_product": """
        select distinct md5(trim(product_name)) as product_key, trim(product_name) as product_name
        from synthetic where product_name is not null""",
    "calendar": "select * from order_days order by date",
    "fct_sales_local": "select * from fct",
    "fct_items": "select * from items",
    "weather_dedup": "select * from weather",
    "forecast_fact": "select * from forecast",
    # --- scalar functions ---
    "slug_keys": """
        select c_custkey, slug, md5(slug) as slug_key
        from (select *, replace(replace(lower(c_mktsegment || '-' || c_name), ' ', '_'), '-', '_') as slug from customer)""",
    "hash_ids": """
        select l_orderkey, l_linenumber, receipt_id, sha256(receipt_id || '|' || l_linenumber::varchar) as line_id
        from (select *, sha256(concat_ws('|', l_orderkey::varchar, nullif(l_returnflag, 'R'), l_linestatus)) as receipt_id
              from lineitem)""",
    "tz_to_local": f"""
        select event_id, l as local_at, l::date as local_date, hour(l)::integer as local_hour, {date_key('l')} as date_key
        from (select event_id, {local('ts', 'timezone')} as l from placed)""",
    "tz_to_utc": f"select event_id, {utc('''date_trunc('milliseconds', ts)''', 'timezone')} as sold_at from placed",
    "price_rounding": f"""
        select l_orderkey, l_linenumber, cast(amount * 10 * discount as decimal(12,2)) as price,
          {ratio_2dp('amount', 'quantity')} as unit_price,
          {ratio_2dp('amount', 'cast(discount * 100 as integer)')} as per_discount_point
        from (select *, cast(l_extendedprice as decimal(12,2)) as amount, cast(l_quantity as integer) as quantity,
                cast(l_discount as decimal(5,2)) as discount from lineitem)""",
    "composite_keys": """
        select count(*) as n_rows,
          count(distinct l_orderkey::varchar || '|' || coalesce(nullif(l_returnflag, 'R'), '-')) as distinct_keys
        from lineitem""",
    # --- checks ---
    "dq_not_null": "select * from ("
    + " union all ".join(
        f"select '{c}' as \"column\", count(*) filter ({c} is null) as n_rows from weather" for c in _WEATHER_COLUMNS
    )
    + ") where n_rows > 0",
    "dq_null_rows": "select city_key, measured_at from weather where temperature_c is null",
    "dq_unique": """
        select sale_item_key, count(*) as n_rows from items where sale_item_key is not null
        group by all having count(*) > 1""",
    "dq_unique_combo": "select sale_key, line_number, count(*) as n_rows from items group by all having count(*) > 1",
    "dq_relationships": """
        select sale_key, count(*) as n_rows from receipts
        where sale_key not in (select sale_key from items) group by all""",
    "dq_local_date": f"""
        select sale_key from fct join city using (city_key) join event_days using (date_key)
        where cast({local('sold_at', 'timezone')} as date) <> date or hour({local('sold_at', 'timezone')}) <>
          case when cast(total_amount_rub * 100 as bigint) % 7 = 0 then hour(sold_at) else hour end""",
    "dq_marts_match": _full_mismatch(
        "hourly", f"select {_DAY_KEY}, sum(sales_count) as n, sum(total_revenue_rub) as r from hourly_mart group by all"
    )
    + " union all "
    + _full_mismatch("daily", f"select {_DAY_KEY}, sales_count + (date_key % 7 = 0)::int as n, total_revenue_rub as r from daily_mart"),
    "dq_product_revenue": """
        select coalesce(p.city_key, s.city_key) as city_key, coalesce(p.date_key, s.date_key) as date_key
        from (select city_key, date_key, sum(product_revenue_rub) as r from product_mart group by all) p
        full join (select city_key, date_key, sum(total_amount_rub) as r from settled group by all) s
          using (city_key, date_key)
        where p.r is distinct from s.r""",
    "dq_items_receipts": "select sale_key, count(*) as n_rows from both_sides group by all",
    "dq_sales_ranges": """
        select 'sale' as source, sale_key as row_key from receipts
        where total_amount_rub - case when sale_key::bigint % 10 = 0 then 50000 else 0 end < 0 or hour not between 0 and 23
        union all
        select 'item', sale_item_key from (
          select *, line_amount_rub - case when sale_key::bigint % 10 = 0 then 3000 else 0 end as net from items)
        where quantity <= 0 or line_number <= 0 or unit_price_rub < 0 or net < 0
          or abs(net - quantity * unit_price_rub) > quantity * 0.01""",
    "dq_weather_ranges": """
        select 'archive' as source, city_key, measured_at as weather_time from weather
        where hour not between 0 and 23 or precipitation_mm < 0 or surface_pressure_hpa <= 0
        union all
        select 'forecast', city_key, forecast_for from forecast
        where forecast_hour not between 0 and 23 or forecast_days <= 0 or precipitation_mm < 0
          or surface_pressure_hpa <= 0 or precipitation_probability_pct not between 0 and 100""",
    "dq_failures": """
        select * from (
          select 'unique line' as "check", cast(coalesce(sum(n), 0) as bigint) as n_rows
          from (select count(*) as n from items group by sale_key, line_number having count(*) > 1)
          union all select 'receipt has lines', count(*) from receipts
            where sale_key not in (select sale_key from items)
          union all select 'line has receipt', count(*) from items
            where sale_key not in (select sale_key from receipts)
          union all select 'items match receipts', count(*) from both_sides
        ) where n_rows > 0""",
    "stored_checks": f"""
        select * from (
          select 'core_fct_sales: not null' as "check", cast(sum((sale_key is null)::int + (source_sale_id is null)::int
            + (city_key is null)::int + (sold_at is null)::int + (date_key is null)::int + (hour is null)::int
            + (total_amount_rub is null)::int + (payment_type is null)::int + (is_synthetic is null)::int) as bigint) as n_rows
          from ({_RECEIPTS_AND_LATE})
          union all select 'core_fct_sales: unique sale_key', cast(sum(n) as bigint)
            from (select count(*) as n from ({_RECEIPTS_AND_LATE}) where sale_key is not null group by sale_key having count(*) > 1)
          union all select 'core_fct_sales: city_key in core_dim_city', count(*) from ({_RECEIPTS_AND_LATE})
            where city_key is not null and city_key not in (select city_key from city)
          union all select 'core_fct_sales: date_key in core_dim_date', count(*) from ({_RECEIPTS_AND_LATE})
            where date_key is not null and date_key not in (select date_key from event_days)
        ) where n_rows > 0""",
    "freshness": f"""
        select newest as max_loaded_at, age as age_seconds,
          case when age > 6 * 3600 then 'error' when age > 2 * 3600 then 'warn' else 'pass' end as status
        from (select max(ts) as newest, cast(floor(epoch(timestamp '{NOW}' - max(ts))) as bigint) as age from events)""",
    # --- upserts and ingest ---
    "upsert_latest": f"""
        select city_slug, measured_at, temperature_c, loaded_at from ({_CELL_LATEST})
        where n = 1 and (bought or not replaced)""",
    "upsert_documents": """
        select city_slug, loaded_at, hour as measured_at,
          case when hour(loaded_at) >= 12 or n < hours then rain end as precipitation_mm,
          case when hour(loaded_at) >= 12 then cast(k as decimal(6,2)) end as apparent_temperature_c from cells""",
    "seed_cities": f"""
        select city_slug, city_name, latitude, longitude, timestamp '{SEEDED_AT}' as updated_at
        from city where city_slug <> 'nation_0'
        union all
        select replace(replace(lower(n), ' ', '_'), '-', '_'), n, lat, lon, timestamp '{NOW}'
        from (values {_SEED_ROWS}) as v(n, lat, lon)""",
    "city_list": "select city_slug, city_name, latitude, longitude from city order by city_slug",
    "archive_window": f"""
        select * from weather
        where measured_at::date between date '2024-01-10' and date '{ANCHOR}' - 6""",
    "incremental_ingest": """
        select user_id, issued_at, event_type, value, ts as loaded_at
        from (select *, date_trunc('hour', ts) as issued_at,
                row_number() over (partition by user_id, date_trunc('hour', ts) order by ts desc) as n from events)
        where n = 1""",
    # --- files and publication ---
    "csv_profiles": "select city_slug, timezone, multiplier as price_multiplier from city",
    "csv_sales_log": "select * replace (cast(floor(money::double / 10) as decimal(3,1)) as money) from log",
    "snapshot_roundtrip": f"""
        select {SYNTHETIC_COLUMNS}, city_name, timestamp '{SEEDED_AT}' as updated_at
        from synthetic join (select city_slug, city_name from city) using (city_slug)""",
    "snapshot_documents": _HOURLY,
    "ndjson_rows": f"select json_object({_JSON_FIELDS})::varchar as line from hourly_mart",
    "mart_contract": "select * from product_mart",
    "publish_check": """
        select count(*) as row_count, cast(sum(units_sold) as bigint) as units_sold,
          cast(sum(receipts_count) as bigint) as receipts_count,
          cast(sum(product_revenue_rub) as decimal(30,2)) as product_revenue_rub,
          count(distinct (city_key, date_key, product_key)) as distinct_keys, 0::bigint as null_rows,
          0::bigint as negative_rows
        from product_mart""",
    "published_hours": "select * from hourly_mart",
    "published_rows": "select * from daily_mart",
}

ORACLE_SQL = {name: _sql(text) for name, text in ORACLES.items()}
