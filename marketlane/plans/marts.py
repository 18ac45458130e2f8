"""Daily marts as mergeable states, and their readers.

A mart row is a partial aggregate.  Any number of partial rows per key may be
stored (one per load, day or micro-batch); the ``*_merge`` readers collapse them.
``by`` adds columns that keep partial rows apart, such as the fact slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketlane.functions.dates import day
from marketlane.functions.sketches import uniq_merge, uniq_merge_state, uniq_state
from marketlane.functions import states
from marketlane.operators import funnel_state, heavy_hitters
from marketlane.schemas import FUNNEL_STEPS, FUNNEL_WINDOW_SECONDS

COMPLETED = "completed"


def completed(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status") == COMPLETED)


def daily_gmv(orders_fact: DataFrame, *by: str) -> DataFrame:
    """Completed orders per day: amount sum, order count, buyer sketch."""
    return (
        completed(orders_fact)
        .groupBy(day("created_at").alias("day"), *by)
        .agg(
            F.sum("total_amount").alias("gmv_state"),
            F.count("*").alias("orders_state"),
            uniq_state("user_id").alias("buyers_state"),
        )
    )


def daily_gmv_collapse(states: DataFrame) -> DataFrame:
    """Several partial rows per day to one, still as states."""
    return states.groupBy("day").agg(
        F.sum("gmv_state").cast("decimal(22,2)").alias("gmv_state"),
        F.sum("orders_state").alias("orders_state"),
        uniq_merge_state("buyers_state").alias("buyers_state"),
    )


def daily_gmv_merge(states: DataFrame) -> DataFrame:
    return states.groupBy("day").agg(
        F.sum("gmv_state").alias("gmv"),
        F.sum("orders_state").alias("orders"),
        uniq_merge("buyers_state").alias("buyers"),
    )


def daily_gmv_exact(orders_fact: DataFrame) -> DataFrame:
    """Same columns with an exact buyer count, straight from the fact."""
    return (
        completed(orders_fact)
        .groupBy(day("created_at").alias("day"))
        .agg(
            F.sum("total_amount").alias("gmv"),
            F.count("*").alias("orders"),
            F.count_distinct("user_id").alias("buyers"),
        )
    )


def category_revenue_daily(order_items_fact: DataFrame, *by: str) -> DataFrame:
    """Revenue and items per day and category; orders of every status count."""
    return order_items_fact.groupBy(
        day("order_created_at").alias("day"), "category_id", "category_name", *by
    ).agg(
        F.sum("line_revenue").cast("decimal(18,2)").alias("revenue"),
        F.sum("quantity").alias("items_sold"),
    )


def category_revenue_merge(counters: DataFrame) -> DataFrame:
    return counters.groupBy("day", "category_id", "category_name").agg(
        F.sum("revenue").alias("revenue"), F.sum("items_sold").alias("items_sold")
    )


def event_counters() -> list[Column]:
    kind = F.col("event_type")
    return [
        F.count_if(kind == "view").alias("views"),
        F.count_if(kind == "cart").alias("carts"),
        F.count_if(kind == "purchase").alias("purchases"),
    ]


def funnel_daily(events_fact: DataFrame, *by: str) -> DataFrame:
    return events_fact.groupBy(day("created_at").alias("day"), *by).agg(*event_counters())


def funnel_merge(counters: DataFrame) -> DataFrame:
    return counters.groupBy("day").agg(
        *[F.sum(c).alias(c) for c in ("views", "carts", "purchases")]
    )


def user_category_first_buy(order_items_fact: DataFrame, *by: str) -> DataFrame:
    return order_items_fact.groupBy("user_id", "category_id", *by).agg(
        F.min("order_created_at").alias("first_buy_state")
    )


def first_buy_merge(states: DataFrame) -> DataFrame:
    return states.groupBy("user_id", "category_id").agg(F.min("first_buy_state").alias("first_buy"))


def session_funnel_cells(events_fact: DataFrame, *by: str) -> DataFrame:
    """Seconds at which each funnel step happened, per session and minute."""
    steps = [F.col("event_type") == s for s in FUNNEL_STEPS]
    return funnel_state.cells(events_fact, ["session_id"], "created_at", steps, *by)


def session_funnel_collapse(cells: DataFrame) -> DataFrame:
    return funnel_state.merge_cells(cells, ["session_id"], len(FUNNEL_STEPS))


def session_levels_merge(cells: DataFrame, window_seconds: int = FUNNEL_WINDOW_SECONDS) -> DataFrame:
    """``session_id, level`` from any partial cells."""
    return funnel_state.levels(cells, ["session_id"], len(FUNNEL_STEPS), window_seconds)


def daily_buyers(orders_fact: DataFrame, user_numbers: DataFrame, *by: str) -> DataFrame:
    """Buyers of completed orders per day, exact, as bitmaps of their numbers."""
    bought = completed(orders_fact).select(day("created_at").alias("day"), "user_id", *by).distinct()
    return states.bitmap_states(bought.join(user_numbers, "user_id"), "number", "day", *by)


def buyers_of_span(bitmaps: DataFrame, first: str, last: str) -> DataFrame:
    """Distinct buyers of a span of days, both ends included, from the mart alone."""
    return states.bitmap_distinct(bitmaps.where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))), out="buyers")


def monthly_buyers(orders_fact: DataFrame, *by: str, log_entries: int = states.THETA_LOG_ENTRIES) -> DataFrame:
    """Buyers of completed orders per month as theta sketches, for overlaps of any two sets."""
    month = F.trunc(F.to_date("created_at"), "MM")
    return completed(orders_fact).groupBy(month.alias("month"), *by).agg(states.theta_state("user_id", log_entries).alias("buyers_state"))


def cohort_members(cohorts: DataFrame, log_entries: int = states.THETA_LOG_ENTRIES) -> DataFrame:
    """Users of each cohort as theta sketches."""
    return cohorts.groupBy("cohort").agg(states.theta_state("user_id", log_entries).alias("members_state"))


def daily_order_values(orders_fact: DataFrame, *by: str, k: int = states.KLL_K) -> DataFrame:
    """Distribution of the amounts of completed orders per day, as KLL sketches."""
    return completed(orders_fact).groupBy(day("created_at").alias("day"), *by).agg(
        states.kll_state("total_amount", k).alias("amount_state"), F.count("total_amount").alias("orders")
    )


def order_value_quantiles(sketches: DataFrame, points: dict[str, float], *by: str, k: int = states.KLL_K) -> DataFrame:
    """Quantiles over any days and partial rows."""
    merged = sketches.groupBy(*by).agg(states.kll_merge("amount_state", k).alias("_s"), F.sum("orders").alias("orders"))
    return merged.select(*by, "orders", *[states.kll_quantile("_s", p).alias(name) for name, p in points.items()])


def product_revenue_summaries(order_items_fact: DataFrame, counters: int = heavy_hitters.COUNTERS) -> DataFrame:
    """Per day and task the products of most revenue, in hundredths, with bounds for all others."""
    cents = order_items_fact.select(
        day("order_created_at").alias("day"), "product_id", (F.col("line_revenue") * 100).cast("bigint").alias("cents")
    )
    return heavy_hitters.summaries(cents, "product_id", "cents", ["day"], counters)
