"""Model inputs derived from the given tables.

nation stands for cities, events for the base sales log and for weather
measurements, orders and lineitem for receipts and lines.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions import clock, keys, money
from tillcast.operators import bitmaps
from tillcast.operators.fanout import fan_out_sales
from tillcast.plans import core, marts, staging
from tillcast.session import written
from tillcast.sources.cities import CITIES, PROFILES

SEEDED_AT = "2024-02-01 00:00:00"


def _pick(values: list, position: Column, type_: str) -> Column:
    """Constant at a position, wrapping around; no join with a constant table."""
    constants = F.array(*[F.lit(v).cast(type_) for v in values])
    return F.element_at(constants, (position % len(values) + 1).cast("int"))


class Inputs:
    """Lazily derived inputs over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # --- cities ---

    @cached_property
    def _nations(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.table("nation").select(
            n.alias("city_no"),
            keys.slug(F.col("n_name")).alias("city_slug"),
            F.col("n_name").alias("city_name"),
            _pick([lat for _, lat, _ in CITIES], n, "decimal(9,5)").alias("latitude"),
            _pick([lon for _, _, lon in CITIES], n, "decimal(9,5)").alias("longitude"),
            _pick([zone for _, zone, _ in PROFILES], n, "string").alias("timezone"),
            _pick([factor for _, _, factor in PROFILES], n, "decimal(5,2)").alias("price_multiplier"),
        )

    @cached_property
    def cities(self) -> DataFrame:
        now = F.lit(SEEDED_AT).cast("timestamp_ntz").alias("updated_at")
        return self._nations.select("city_slug", "city_name", "latitude", "longitude", now)

    @cached_property
    def profiles(self) -> DataFrame:
        return self._nations.select("city_slug", "timezone", "price_multiplier")

    @cached_property
    def known_profiles(self) -> DataFrame:
        """Profiles of as many cities as the profile list is long; the rest have none."""
        return self._nations.filter(F.col("city_no") < len(PROFILES)).select(*self.profiles.columns)

    @cached_property
    def dim_city(self) -> DataFrame:
        return core.dim_city(self.cities, self.profiles)

    # --- events: sales log, weather, forecasts ---

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))

    def in_city(self, events: DataFrame) -> DataFrame:
        """Place an event in a city by its user."""
        cities = self._nations.select("city_no", "city_slug")
        return events.withColumn("city_no", (F.col("user_id") % 25).cast("int")).join(cities, "city_no")

    def _named(self, events: DataFrame) -> DataFrame:
        """Name the product of an event; cash sales were typed with a stray space."""
        parts = self.table("part").select(F.col("p_partkey").alias("k"), "p_name")
        paid = F.when(F.col("k") < 50, "card").otherwise("cash")
        return (
            events.join(parts, "k", "left")
            .withColumn("cash_type", paid)
            .withColumn(
                "coffee_name",
                F.when(F.col("k") < 50, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" "))),
            )
        )

    @cached_property
    def sales_log(self) -> DataFrame:
        ts = F.col("ts")
        hour = F.hour(ts)
        sold = self._named(self.events)
        return sold.select(
            hour.alias("hour_of_day"),
            "cash_type",
            F.col("value").cast(money.AMOUNT).alias("money"),
            "coffee_name",
            F.when(hour < 12, "Morning").when(hour < 17, "Afternoon").otherwise("Night").alias("time_of_day"),
            F.date_format(ts, "EEE").alias("weekday"),
            F.date_format(ts, "MMM").alias("month_name"),
            (F.weekday(ts) + 1).alias("weekdaysort"),
            F.month(ts).alias("monthsort"),
            F.to_date(ts).alias("date"),
            F.date_format(ts, "HH:mm:ss.SSS").alias("time"),
        )

    @cached_property
    def coarse_sales_log(self) -> DataFrame:
        """All events as sales timed to the hour: holds identical and free sales."""
        ts = F.col("ts")
        return self._named(self.events).select(
            F.col("event_type").alias("cash_type"),
            F.col("k").cast(money.AMOUNT).alias("money"),
            "coffee_name",
            F.to_date(ts).alias("date"),
            F.date_format(ts, "HH:00:00.000").alias("time"),
        )

    @cached_property
    def n_sales(self) -> int:
        """Rows of the events, from the footers of their files."""
        return self.table("events").count()

    @cached_property
    def synthetic(self) -> DataFrame:
        return fan_out_sales(self.sales_log, self.cities, self.profiles, n_sales=self.n_sales)

    @cached_property
    def staged_sales(self) -> DataFrame:
        return staging.stg_synthetic_sales(self.synthetic)

    @cached_property
    def event_dates(self) -> DataFrame:
        """Calendar of the events; one day more, as all cities are ahead of UTC."""
        days = self.table("events").agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b"))
        return core.calendar(days, F.date_sub("a", 1), F.date_add("b", 1))

    @cached_property
    def fct_sales(self) -> DataFrame:
        return core.fct_sales(self.staged_sales, self.dim_city, self.event_dates)

    @cached_property
    def fct_sales_by_day(self) -> DataFrame:
        """The same receipts, few days a task."""
        synthetic = fan_out_sales(self.sales_log, self.cities, self.profiles, by_day=True, n_sales=self.n_sales)
        return core.fct_sales(staging.stg_synthetic_sales(synthetic), self.dim_city, self.event_dates)

    @cached_property
    def weather_loads(self) -> DataFrame:
        """Measurements as staged loads; several loads cover the same hour."""
        ts, kind = F.col("ts"), F.col("event_type")
        measured = self.in_city(self.events)
        return measured.select(
            "city_slug",
            F.to_date(ts).alias("period_start"),
            F.to_date(ts).alias("period_end"),
            ts.alias("loaded_at"),
            clock.hour_start(ts).alias("measured_at"),
            F.when(kind != "error", F.col("value")).cast("decimal(12,5)").alias("precipitation_mm"),
            F.when(kind != "signup", F.col("value")).cast("decimal(6,2)").alias("temperature_c"),
            (F.col("k") + 900).cast("decimal(8,2)").alias("surface_pressure_hpa"),
            F.col("k").cast("decimal(6,2)").alias("apparent_temperature_c"),
        )

    @cached_property
    def fct_weather(self) -> DataFrame:
        return core.fct_weather_hour(self.weather_loads, self.dim_city, self.event_dates)

    @cached_property
    def forecast_issues(self) -> DataFrame:
        """Each measurement as a forecast some hours ahead; some probabilities exceed 100."""
        ts = F.col("ts")
        issued = clock.hour_start(ts)
        measured = self.in_city(self.events)
        return measured.select(
            "city_slug",
            issued.alias("issued_at"),
            F.timestamp_add("HOUR", F.col("k") % 48, issued).alias("forecast_for"),
            F.lit(3).alias("forecast_days"),
            F.col("value").cast("decimal(6,2)").alias("temperature_c"),
            F.col("k").cast("decimal(6,2)").alias("apparent_temperature_c"),
            (F.col("value") - 1).cast("decimal(12,5)").alias("precipitation_mm"),
            F.col("k").cast("decimal(8,2)").alias("surface_pressure_hpa"),
            (F.col("k") + 5).cast("decimal(6,2)").alias("precipitation_probability_pct"),
            ts.alias("loaded_at"),
        )

    @cached_property
    def forecast_dates(self) -> DataFrame:
        days = self.table("events").agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b"))
        return core.calendar(days, F.date_sub("a", 1), F.date_add("b", 4))

    @cached_property
    def fct_forecast(self) -> DataFrame:
        return core.fct_weather_forecast_hour(self.forecast_issues, self.dim_city, self.forecast_dates)

    # --- documents ---

    @cached_property
    def document_hours(self) -> DataFrame:
        """Hourly cells of each user and day, at most 24 per document."""
        ts = F.col("ts")
        placed = self.in_city(self.events)
        return placed.groupBy(
            "user_id", "city_no", "city_slug", F.to_date(ts).alias("day"),
            clock.hour_start(ts).alias("hour"),
        ).agg(
            F.max(F.col("value").cast("decimal(6,2)")).alias("temperature"),
            F.min(F.col("value").cast("decimal(12,5)")).alias("rain"),
            F.max("k").alias("k"),
            F.max("ts").alias("newest"),
        )

    def documents(self, ragged: bool = False) -> DataFrame:
        """Archive documents: the cells of a user and day as parallel arrays.

        A ragged document lacks the last element of one array and all of another.
        """
        cell = F.struct("hour", "temperature", "rain", "k")
        grouped = self.document_hours.groupBy("user_id", "city_no", "city_slug", "day").agg(
            F.sort_array(F.collect_list(cell)).alias("cells"), F.max("newest").alias("loaded_at")
        )
        cells = F.col("cells")
        rain = F.transform(cells, lambda c: c["rain"].cast("string"))
        hourly = [
            F.transform(cells, lambda c: F.date_format(c["hour"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
            (F.slice(rain, 1, F.size(rain) - 1) if ragged else rain).alias("precipitation"),
            F.transform(cells, lambda c: c["temperature"].cast("string")).alias("temperature_2m"),
            F.transform(cells, lambda c: (c["k"] + 900).cast("string")).alias("surface_pressure"),
            F.transform(cells, lambda c: (c["k"] + 5).cast("string")).alias("precipitation_probability"),
        ]
        if not ragged:
            hourly.append(F.transform(cells, lambda c: c["k"].cast("string")).alias("apparent_temperature"))
        place = [
            _pick([lat for _, lat, _ in CITIES], F.col("city_no"), "string").alias("latitude"),
            _pick([lon for _, _, lon in CITIES], F.col("city_no"), "string").alias("longitude"),
        ]
        payload = F.to_json(F.struct(*place, F.struct(*hourly).alias("hourly")))
        return grouped.select(
            "user_id", "city_slug", F.col("day").alias("period_start"), F.col("day").alias("period_end"),
            payload.alias("payload"), "loaded_at",
        )

    @cached_property
    def forecast_documents(self) -> DataFrame:
        return self.documents().select(
            "user_id", "city_slug", F.col("period_start").cast("timestamp_ntz").alias("issued_at"),
            F.lit(3).alias("forecast_days"), "payload", "loaded_at",
        )

    # --- orders and lineitem: receipts with several lines ---

    @cached_property
    def products(self) -> DataFrame:
        return core.dim_product(self.table("part").select(F.col("p_name").alias("product_name")))

    @cached_property
    def order_lines(self) -> DataFrame:
        """Lines in the columns the item fact reads; some repeat a line number."""
        parts = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
        lines = self.table("lineitem").join(parts, "l_partkey", "left")
        return lines.select(
            keys.sha256_id(F.col("l_orderkey"), F.col("l_linenumber")).alias("synthetic_sale_item_id"),
            F.col("l_orderkey").cast("string").alias("synthetic_sale_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast(money.AMOUNT).alias("amount_rub"),
            F.concat(F.lit(" "), F.col("p_name")).alias("product_name"),
        )

    @cached_property
    def n_lines(self) -> int:
        """Rows of the lines, from the footers of their files."""
        return self.table("lineitem").count()

    @cached_property
    def fct_items(self) -> DataFrame:
        return core.fct_sales_item(self.order_lines, self.products)

    @cached_property
    def receipts(self) -> DataFrame:
        """Orders as receipts of the customer's city, totalled as ordered."""
        customers = self.table("customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("city_no")
        )
        placed = self.table("orders").join(customers, "o_custkey").join(self._nations, "city_no")
        return placed.select(
            F.col("o_orderkey").cast("string").alias("sale_key"),
            keys.md5_key(F.col("city_slug")).alias("city_key"),
            clock.date_key(F.col("o_orderdate")).alias("date_key"),
            F.hour("o_orderdate").alias("hour"),
            F.col("o_totalprice").cast(money.AMOUNT).alias("total_amount_rub"),
        )

    @cached_property
    def sold_items(self) -> DataFrame:
        return marts.items_with_sales(self.fct_items, self.receipts, self.n_lines)

    @cached_property
    def settled_receipts(self) -> DataFrame:
        """Receipts totalled from their lines, but every tenth as ordered."""
        sums = self.order_lines.groupBy(F.col("synthetic_sale_id").alias("sale_key")).agg(
            F.sum("amount_rub").cast(money.AMOUNT).alias("settled")
        )
        total = F.when(F.col("sale_key").cast("bigint") % 10 == 0, F.col("total_amount_rub")).otherwise(F.col("settled"))
        return self.receipts.join(sums, "sale_key", "left").withColumn("total_amount_rub", total).drop("settled")

    @cached_property
    def order_dates(self) -> DataFrame:
        days = self.table("orders").agg(
            F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")
        )
        return core.calendar(days, F.col("a"), F.col("b"))

    # --- marts ---

    @cached_property
    def receipt_words(self) -> DataFrame:
        """Receipts of each city, day and product as bits."""
        numbers = written(bitmaps.numbered(self.receipts, ["city_key", "date_key"]), "receipt-numbers")
        return written(bitmaps.receipt_words(self.sold_items, numbers, ["city_key", "date_key", "product_key"]), "receipt-words")

    @cached_property
    def daily_mart(self) -> DataFrame:
        return marts.mart_sales_weather_daily(self.fct_sales, self.fct_weather, self.dim_city, self.event_dates)

    @cached_property
    def hourly_mart(self) -> DataFrame:
        # The fan-out behind the sales is run once: its hours are written and read for the period and for the hours.
        hours = written(marts.sales_hours(self.fct_sales), "sales-hours")
        return marts.hourly_from_hours(hours, self.fct_weather, self.dim_city, self.event_dates)

    @cached_property
    def product_mart(self) -> DataFrame:
        return marts.mart_product_sales_daily(
            self.fct_items, self.receipts, self.dim_city, self.products, self.order_dates, self.n_lines
        )
