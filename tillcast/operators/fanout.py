"""Multiply a base sales log across cities (one row per sale and city)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions import clock, keys, money

# Published columns of the fan-out, in order.
COLUMNS = [
    "source_sale_id", "synthetic_sale_id", "synthetic_sale_item_id", "city_slug", "timezone",
    "date", "sold_at", "product_name", "payment_type", "amount_money", "price_multiplier",
    "amount_rub", "quantity", "line_number", "is_synthetic",
]

#: Sales of a part, where their number is known: a file's dictionary, 1 MB by default, holds the ids of some 15 000.
SALES_A_PART = 12_000


def city_directory(cities: DataFrame, profiles: DataFrame) -> DataFrame:
    """Cities with zone and multiplier; a city without a profile keeps nulls."""
    return cities.select("city_slug").join(
        profiles.select("city_slug", "timezone", "price_multiplier"), "city_slug", "left"
    )


def tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def parts_of(sales: DataFrame, n_sales: int | None) -> int:
    """As many parts as a shuffle has; of a log of so many sales, more where these would hold over SALES_A_PART."""
    return max(tasks(sales), -(-(n_sales or 0) // SALES_A_PART))


def dealt_out(sales: DataFrame, by_day: bool = False, parts: int | None = None) -> DataFrame:
    """The log in so many even parts (as many as a shuffle has); ``by_day``, each of few days.

    A log of few files would otherwise be multiplied and hashed in as few tasks. Its columns are narrow
    and its rows a fraction of what comes out, so this exchange costs little beside them. A day that holds
    most sales is cut by a number that each row draws.
    """
    parts = parts or tasks(sales)
    if not by_day:
        return sales.repartition(parts)
    drawn = sales.withColumn("_drawn", F.monotonically_increasing_id())
    return drawn.repartitionByRange(parts, "date", "_drawn").drop("_drawn")


def computed_once(df: DataFrame, parts: int) -> DataFrame:
    """``df`` with its columns computed before its rows are multiplied.

    Spark fuses a projection with the joins that follow and puts its expressions off until they are read, which is once
    for every match of a row. A coalesce to as many parts as there are moves no row and ends the fused code.
    """
    return df.coalesce(parts)


def per_city(sales: DataFrame, directory: DataFrame) -> DataFrame:
    """Every sale once per directory row.

    Each sale draws one salt and the directory is copied for every salt, so an equi-join on it gives all pairs. The log
    isn't copied before the join: Spark broadcasts a short directory, and a long one joins evenly over the salts, which
    are as many as a shuffle's parts. Which salt a sale draws makes no difference to the rows. Cities of a zone and price
    stand together, so a sale's instants come in runs, which columnar files keep as one value and a count.
    """
    salts = tasks(sales)
    salted = sales.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    directory = directory.sortWithinPartitions("timezone", "price_multiplier")
    copies = directory.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, "_salt").drop("_salt")


def source_sale_id() -> Column:
    """Content hash of a sale: the same in all cities, and for identical sales."""
    return keys.sha256_id(*[F.col(c) for c in ("date", "time", "product_name", "amount_money", "payment_type")])


def fan_out_sales(sales: DataFrame, cities: DataFrame, profiles: DataFrame, by_day: bool = False, n_sales: int | None = None) -> DataFrame:
    """Synthetic sales: priced per city and placed in the city's own time.

    The log's date and time are read as the wall clock of each city. ``by_day`` gives the same rows, few days a task; with
    ``n_sales``, the log's rows, parts grow in number and not in size.
    """
    narrow = sales.select(
        "date",
        "time",
        F.col("coffee_name").alias("product_name"),
        F.col("money").alias("amount_money"),
        F.col("cash_type").alias("payment_type"),
    )
    parts = parts_of(sales, n_sales)
    base = dealt_out(narrow, by_day, parts).withColumns(
        {
            "source_sale_id": source_sale_id(),
            "_wall": clock.wall_clock(F.col("date"), F.col("time")),
        }
    )
    expanded = per_city(computed_once(base, parts), city_directory(cities, profiles))
    receipts = expanded.withColumns(
        {
            "synthetic_sale_id": keys.sha256_id(F.col("source_sale_id"), F.col("city_slug")),
            "sold_at": clock.to_utc(F.col("_wall"), F.col("timezone")),
            "amount_rub": money.price(F.col("amount_money"), F.col("price_multiplier")),
            "line_number": F.lit(1),
            "quantity": F.lit(1),
            "is_synthetic": F.lit(True),
        }
    )
    lines = receipts.withColumn(
        "synthetic_sale_item_id", keys.sha256_id(F.col("synthetic_sale_id"), F.col("line_number"))
    )
    return lines.select(*COLUMNS)
