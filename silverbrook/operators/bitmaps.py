"""Distinct counts that can be added up: exact bitmaps over near-dense numbers.

A mart of daily distinct counts can't tell how many customers a quarter had. Here values get numbers,
and a mart holds per group the set of numbers as bitmaps of 32,768 bits; sets of groups are united and
counted exactly, without the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverbrook.functions import values as V

# Values are numbered in so many slots side by side, so no task numbers more than its share of them.
SLOTS = 1024


def numbers(rows: DataFrame, column: str, slots: int = SLOTS) -> DataFrame:
    """(column, number): a number from 0 for every value, unique and near-dense.

    Values are dealt to slots by hash and numbered in order within their slot; numbers of slots are
    interlaced. Nulls get none. The same values get the same numbers.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(slots))
    values = rows.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_slot", slot)
    place = F.row_number().over(Window.partitionBy("_slot").orderBy(column)) - 1
    return values.select(column, (place.cast("bigint") * slots + F.col("_slot")).alias("number"))


def sets(rows: DataFrame, keys: list[str], number: str, name: str) -> DataFrame:
    """The set of numbers of every group: a row per 32,768 numbers, with the bits of those present.

    Numbers of a set are spread over all tasks, so a bitmap of 4 KB per task and set would be shuffled,
    which grows with the square of the input. Numbers are dealt by set first, and a set is built once:
    callers hand in distinct rows, so that a set has 32,768 of them at most.
    """
    dealt = rows.where(F.col(number).isNotNull()).select(
        *keys, F.bitmap_bucket_number(number).alias("block"), F.bitmap_bit_position(number).alias("_bit"))
    return dealt.repartition(*keys, "block").groupBy(*keys, "block").agg(F.bitmap_construct_agg("_bit").alias(name))


def united(marts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct numbers of coarser groups, as ``name``: blocks are united, then counted."""
    blocks = marts.groupBy(*keys, "block").agg(F.bitmap_or_agg(name).alias(name))
    return blocks.groupBy(*keys).agg(F.sum(F.bitmap_count(name)).alias(name))


# -- marts -------------------------------------------------------------------------------


def daily_totals(sales: DataFrame, reviews: DataFrame) -> DataFrame:
    """Additive measures per day, of orders that occur once, and of the reviews of the day's orders."""
    ratings = reviews.groupBy("order_id").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("n_ratings"))
    joined = sales.select("purchase_date", "order_id", "total_value").join(ratings, "order_id", "left")
    return joined.groupBy("purchase_date").agg(
        F.count("order_id").alias("orders"),
        F.sum(V.exact("total_value")).alias("revenue"),
        F.count("total_value").alias("n_values"),
        F.coalesce(F.sum("rating_sum"), F.lit(0)).alias("rating_sum"),
        F.coalesce(F.sum("n_ratings"), F.lit(0)).alias("n_ratings"),
    )


def daily_customers(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """The customers of every day, by their numbers."""
    numbered = sales.select("purchase_date", "customer_id").distinct().join(customers, "customer_id")
    return sets(numbered, ["purchase_date"], "number", "customers")


def daily_visitors(clicks: DataFrame, column: str, visitors: DataFrame) -> DataFrame:
    """The sessions or users of every day and event type, by their numbers."""
    keys = ["event_date", "event_type"]
    numbered = clicks.select(*keys, column).distinct().join(visitors, column)
    return sets(numbered, keys, "number", f"{column.removesuffix('_id')}s")


# -- reports -----------------------------------------------------------------------------


def since(mart: DataFrame, column: str, days: int) -> Column:
    """``days`` before a mart's last day; the mart is small."""
    return mart.agg(F.date_sub(F.max(column), days).alias("d")).scalar()


def kpi_totals(totals: DataFrame, customers: DataFrame, days: int) -> DataFrame:
    """Headline numbers of the last days from the daily marts alone: each customer counts once."""
    first = since(totals, "purchase_date", days)
    sums = totals.where(F.col("purchase_date") >= first).agg(
        F.sum("revenue").cast("double").alias("total_revenue"),
        F.sum("orders").alias("total_orders"),
        V.ratio(F.sum("revenue").cast("double"), F.sum("n_values")).alias("avg_order_value"),
        V.ratio(F.sum("rating_sum"), F.sum("n_ratings")).alias("avg_rating"),
    )
    recent = customers.where(F.col("purchase_date") >= first)
    count = F.coalesce(united(recent, [], "customers").select("customers").scalar(), F.lit(0))
    return sums.withColumn("total_customers", count)


def visitors_per_type(
    sessions: DataFrame, users: DataFrame, days: int
) -> DataFrame:
    """Distinct sessions and users of every event type over the last days, from the daily marts alone."""
    first = since(sessions, "event_date", days)
    counts = [united(mart.where(F.col("event_date") >= first), ["event_type"], name)
              for mart, name in ((sessions, "sessions"), (users, "users"))]
    of = counts[1].withColumnRenamed("event_type", "of_type")
    joined = counts[0].join(of, F.col("event_type").eqNullSafe(F.col("of_type")), "full_outer")
    zero = F.lit(0).cast("bigint")
    return joined.select(F.coalesce("event_type", "of_type").alias("event_type"),
                         F.coalesce("sessions", zero).alias("sessions"), F.coalesce("users", zero).alias("users"))


def visitors_per_day(sessions: DataFrame, users: DataFrame, days: int) -> DataFrame:
    """Distinct sessions and users of each of the last days over all event types."""
    first = since(sessions, "event_date", days)
    counts = [united(mart.where(F.col("event_date") >= first), ["event_date"], name)
              for mart, name in ((sessions, "sessions"), (users, "users"))]
    joined = counts[0].join(counts[1], "event_date", "full_outer")
    zero = F.lit(0).cast("bigint")
    return joined.select("event_date", F.coalesce("sessions", zero).alias("sessions"),
                         F.coalesce("users", zero).alias("users"))
