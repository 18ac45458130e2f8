"""Business questions on top of marts and facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marketlane.functions import states
from marketlane.functions.dates import month_start, months_between_starts
from marketlane.functions.sketches import uniq_adaptive, uniq_hll12
from marketlane.operators.basket import category_pairs
from marketlane.operators.cohorts import active_months, retention
from marketlane.operators.copies import latest_version
from marketlane.operators.funnel import level_histogram, window_funnel
from marketlane.operators.heavy_hitters import top_sums
from marketlane.operators.percentiles import percentiles
from marketlane.plans.marts import completed
from marketlane.schemas import (
    FUNNEL_STEPS,
    FUNNEL_WINDOW_SECONDS,
    SEGMENT_NO_PROMO,
    SEGMENT_PROMO,
)


def ratio(a: Column, b: Column, digits: int) -> Column:
    """Rounded ratio, NULL when the divisor is zero."""
    return F.round(a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0)), digits)


def gmv_by_day(merged: DataFrame) -> DataFrame:
    """GMV, orders, buyers and average order value per day."""
    aov = F.round(F.col("gmv") / F.col("orders"), 2)
    return merged.select("day", "gmv", "orders", "buyers", aov.alias("aov")).orderBy("day")


def top_categories(category_revenue: DataFrame, n: int = 10) -> DataFrame:
    """Highest revenue; equal revenue is ordered by name."""
    return (
        category_revenue.groupBy("category_name")
        .agg(F.round(F.sum("revenue"), 0).alias("revenue"), F.sum("items_sold").alias("items"))
        .orderBy(F.desc("revenue"), "category_name")
        .limit(n)
    )


def registration_cohorts(users_dim_versions: DataFrame) -> DataFrame:
    """Latest version of each user with the month of registration."""
    current = latest_version(users_dim_versions, ["user_id"], "updated_at")
    return current.select("user_id", month_start("registration_date").alias("cohort"))


def first_purchase_cohorts(orders_fact: DataFrame) -> DataFrame:
    first = completed(orders_fact).groupBy("user_id").agg(F.min("created_at").alias("first_buy"))
    return first.select("user_id", month_start("first_buy").alias("cohort"))


def cohort_retention(cohorts: DataFrame, orders_fact: DataFrame) -> DataFrame:
    activity = active_months(completed(orders_fact), "user_id", "created_at")
    return retention(cohorts, activity, "user_id").orderBy("cohort", "month_offset")


def retention_from_sketches(members: DataFrame, buyers: DataFrame) -> DataFrame:
    """``cohort, month_offset, users, larger``: estimated overlap of cohorts and monthly buyers, from sketches alone.

    ``larger`` is the size of the larger of the two sets, for the bound.  Months
    are few, so each cohort is repeated for the months from its own to the last.
    """
    months = buyers.groupBy("month").agg(states.theta_merge("buyers_state").alias("_b"))
    last = months.agg(F.max("month")).first()[0]
    if last is None:
        return members.select("cohort", F.lit(0).alias("month_offset"), F.lit(0).cast("bigint").alias("users"), F.lit(0).cast("bigint").alias("larger")).limit(0)
    ahead = F.sequence("cohort", F.lit(last), F.expr("interval 1 month"))
    open_months = members.where(F.col("cohort") <= F.lit(last)).select("cohort", "members_state", F.explode(ahead).alias("month"))
    # One sketch a month is sent to all tasks; a cohort's sketch is repeated for its months in the task that holds it.
    pairs = open_months.join(F.broadcast(months), "month")
    size = lambda c: F.theta_sketch_estimate(c)
    return pairs.select(
        "cohort",
        months_between_starts("cohort", "month").alias("month_offset"),
        states.theta_overlap("members_state", "_b").alias("users"),
        F.greatest(size("members_state"), size("_b")).alias("larger"),
    )


def top_products(order_items_fact: DataFrame, n: int = 10, summaries: DataFrame | None = None) -> DataFrame:
    """Products of highest revenue, exact; equal revenue is ordered by id."""
    cents = order_items_fact.select("product_id", (F.col("line_revenue") * 100).cast("bigint").alias("cents"))
    best = top_sums(cents, "product_id", "cents", n, summaries)
    return best.select("product_id", (F.col("weight") / 100).cast("decimal(18,2)").alias("revenue"))


def session_funnel(
    events_fact: DataFrame,
    key: Sequence[str] = ("session_id",),
    window_seconds: int = FUNNEL_WINDOW_SECONDS,
) -> DataFrame:
    """How many sessions reached each step of view, cart, purchase."""
    steps = [F.col("event_type") == s for s in FUNNEL_STEPS]
    levels = window_funnel(events_fact, key, "created_at", steps, window_seconds)
    return level_histogram(levels).orderBy("level")


def promo_impact(orders_fact: DataFrame) -> DataFrame:
    """Average order value and discount of orders with and without promotion."""
    segment = F.when(F.col("discount_amount") > 0, SEGMENT_PROMO).otherwise(SEGMENT_NO_PROMO)
    return (
        completed(orders_fact)
        .groupBy(segment.alias("segment"))
        .agg(
            F.count("*").alias("orders"),
            F.round(F.avg("total_amount"), 2).alias("aov"),
            F.round(F.sum("total_amount"), 0).alias("gmv"),
            F.round(F.avg("discount_amount"), 2).alias("avg_discount"),
        )
    )


def market_basket(order_items_fact: DataFrame, n: int = 15) -> DataFrame:
    pairs = category_pairs(order_items_fact, "order_id", "category_name")
    return pairs.orderBy(F.desc("together"), "cat_a", "cat_b").limit(n)


def distinct_three_ways(rows: DataFrame, column: str) -> DataFrame:
    """Exact count and both estimates in one pass.

    Sketches ignore repeats, so they may be fed the distinct values that the
    exact count needs anyway.  Next to a DISTINCT aggregate Spark would keep one
    sketch per distinct value instead.
    """
    return rows.select(column).distinct().agg(
        F.count(column).alias("exact"),
        uniq_adaptive(column).alias("combined"),
        uniq_hll12(column).alias("hll12"),
    )


def kpi_card(gmv_merged: DataFrame, funnel_merged: DataFrame) -> DataFrame:
    """One row: GMV, orders, average order value, view to purchase conversion."""
    sales = gmv_merged.agg(F.sum("gmv").alias("gmv"), F.sum("orders").alias("orders"))
    traffic = funnel_merged.agg(F.sum("views").alias("views"), F.sum("purchases").alias("purchases"))
    both = sales.withColumns({"views": F.lit(None).cast("bigint"), "purchases": F.lit(None).cast("bigint")}).unionByName(
        traffic.withColumns({"gmv": F.lit(None).cast("decimal(38,2)"), "orders": F.lit(None).cast("bigint")})
    )
    totals = both.agg(*[F.max(c).alias(c) for c in ("gmv", "orders", "views", "purchases")])
    return totals.select(
        "gmv", "orders",
        ratio(F.col("gmv"), F.col("orders"), 2).alias("aov"),
        ratio(F.col("purchases"), F.col("views"), 4).alias("conversion"),
    )


def by_payment_method(orders_fact: DataFrame) -> DataFrame:
    return (
        completed(orders_fact)
        .groupBy("payment_method")
        .agg(F.count("*").alias("orders"), F.sum("total_amount").alias("gmv"))
    )


def step_conversions(funnel_merged: DataFrame) -> DataFrame:
    return funnel_merged.select(
        "day", "views", "carts", "purchases",
        ratio(F.col("carts"), F.col("views"), 4).alias("view_to_cart"),
        ratio(F.col("purchases"), F.col("carts"), 4).alias("cart_to_purchase"),
    )


def missing_sales_days(gmv_merged: DataFrame) -> DataFrame:
    """Days between the first and the last sale on which nothing was sold."""
    bounds = gmv_merged.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    calendar = bounds.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return calendar.join(gmv_merged.select("day"), "day", "left_anti")


def pipeline_health(etl_log: DataFrame) -> DataFrame:
    return etl_log.groupBy("source_date", "target_table", "status").agg(
        F.count("*").alias("runs"),
        F.sum("rows").alias("rows"),
        F.round(F.sum("seconds"), 3).alias("seconds"),
    )


def order_total_check(orders: DataFrame, order_items: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Does each order's total equal its items minus the discount?  Counts per outcome."""
    gross = order_items.groupBy("order_id").agg(
        F.sum((F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)")).alias("gross")
    )
    expected = F.coalesce("gross", F.lit(0).cast("decimal(18,2)")) - F.coalesce(
        "discount_amount", F.lit(0).cast("decimal(12,2)")
    )
    gap = F.abs(F.col("total_amount") - expected)
    return (
        orders.join(gross, "order_id", "left")
        .select(
            F.when(F.col("gross").isNull(), "no_items")
            .when(gap <= F.lit(tolerance).cast("decimal(12,2)"), "match")
            .otherwise("mismatch")
            .alias("outcome"),
            gap.cast("decimal(20,2)").alias("gap"),
        )
        .groupBy("outcome")
        .agg(F.count("*").alias("orders"), F.sum("gap").alias("total_gap"))
    )


def payment_status_check(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders per status and payment status, with whether the two agree."""
    paid = payments.select("order_id", F.col("status").alias("payment_status"))
    status, payment = F.col("status"), F.col("payment_status")
    agrees = (
        ((status == "completed") & (payment == "succeeded"))
        | ((status == "returned") & (payment == "refunded"))
        | ((status == "cancelled") & (payment.isNull() | (payment == "failed")))
    )
    return (
        orders.join(paid, "order_id", "left")
        .groupBy("status", "payment_status", F.coalesce(agrees, F.lit(False)).alias("consistent"))
        .agg(F.count("*").alias("orders"))
    )


def orders_per_buyer(orders: DataFrame) -> DataFrame:
    """Median, 99th percentile and maximum of orders per buyer."""
    per_buyer = orders.groupBy("user_id").agg(F.count("*").alias("n_orders"))
    found = percentiles(per_buyer, "n_orders", {"median": 0.5, "p99": 0.99})
    return found.withColumn("max_value", F.col("max_value").cast("bigint"))


def orders_per_month(orders: DataFrame) -> DataFrame:
    return orders.groupBy(month_start("created_at").alias("month")).agg(F.count("*").alias("orders"))


def median_price(products: DataFrame) -> DataFrame:
    return percentiles(products, "price", {"median_price": 0.5}, scale=2)


def event_totals(events_fact: DataFrame) -> DataFrame:
    return events_fact.groupBy("event_type").agg(F.count("*").alias("events"))


def completed_gmv_by_day(orders: DataFrame) -> DataFrame:
    """Control total taken from core, without facts or marts."""
    return (
        completed(orders)
        .groupBy(F.to_date("created_at").alias("day"))
        .agg(F.sum("total_amount").alias("gmv"))
    )


def quarantine_completeness(rejected: DataFrame, expected: DataFrame) -> DataFrame:
    """Rejects per table and reason against the known number of injected defects."""
    found = rejected.groupBy("source_table", "reason").agg(F.count("*").alias("found"))
    keys = ["source_table", "reason"]
    return expected.join(found, keys, "left").select(
        *keys, "expected", F.coalesce("found", F.lit(0)).alias("found"),
        (F.coalesce("found", F.lit(0)) >= F.col("expected")).alias("complete"),
    )
