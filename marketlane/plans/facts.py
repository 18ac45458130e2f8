"""Core to denormalised dimensions and facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from marketlane.functions.columns import flag
from marketlane.functions.dates import in_days, whole_seconds
from marketlane.schemas import NO_CATEGORY_ID, NO_CATEGORY_NAME


def users_dim(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id", "email", "full_name", "registration_date",
        "acquisition_channel", "city", "age_group", flag("is_active").alias("is_active"),
    )


def with_parent_names(categories: DataFrame) -> DataFrame:
    """Two-level tree: each category with the name of its parent."""
    parents = categories.select(
        F.col("category_id").alias("parent_id"), F.col("name").alias("parent_name")
    )
    return categories.join(parents, "parent_id", "left")


def category_lookup(rows: DataFrame, categories: DataFrame, out: str = "category_name") -> DataFrame:
    """Dictionary lookup of a category name; unknown ids give NULL."""
    names = categories.select("category_id", F.col("name").alias(out))
    return rows.join(names, "category_id", "left")


def _named_category(rows: DataFrame, categories: DataFrame) -> DataFrame:
    return category_lookup(rows, categories).withColumns(
        {
            "category_id": F.coalesce("category_id", F.lit(NO_CATEGORY_ID)),
            "category_name": F.coalesce("category_name", F.lit(NO_CATEGORY_NAME)),
        }
    )


def products_dim(products: DataFrame, categories: DataFrame, fill_parent: bool = False) -> DataFrame:
    """Parent category is an empty text unless ``fill_parent`` asks for the tree."""
    parent = F.lit("")
    rows = _named_category(products, categories)
    if fill_parent:
        tree = with_parent_names(categories).select("category_id", "parent_name")
        rows = rows.join(tree, "category_id", "left")
        parent = F.coalesce("parent_name", F.lit(""))
    return rows.select(
        "product_id", F.col("name"), "category_id", "category_name",
        parent.alias("parent_category"), "price", "cost_price",
        F.coalesce("rating", F.lit(0).cast("decimal(3,2)")).alias("rating"),
        flag("is_available").alias("is_available"),
    )


def _slice(rows: DataFrame, ts: str, days: Sequence[str] | None) -> DataFrame:
    return rows.where(in_days(ts, days)) if days else rows


def orders_fact(
    orders: DataFrame, users: DataFrame, order_items: DataFrame, days: Sequence[str] | None = None
) -> DataFrame:
    """Orders with user attributes and item count, for the listed days or for all.

    Items are counted before the join; for listed days only their orders are counted.
    """
    day_orders = _slice(orders, "created_at", days)
    items = order_items.select("order_id")
    if days:
        items = items.join(day_orders.select("order_id"), "order_id", "left_semi")
    counts = items.groupBy("order_id").agg(F.count("*").alias("cnt"))
    buyers = users.select("user_id", "acquisition_channel", "city", "age_group")
    return (
        day_orders.join(buyers, "user_id")
        .join(counts, "order_id", "left")
        .select(
            "order_id", "user_id", "created_at", "status", "payment_method",
            "total_amount", "discount_amount",
            F.coalesce("cnt", F.lit(0)).cast("int").alias("items_count"),
            "acquisition_channel", F.col("city").alias("user_city"),
            F.col("age_group").alias("user_age_group"),
        )
    )


def orders_fact_join_then_group(
    orders: DataFrame, users: DataFrame, order_items: DataFrame
) -> DataFrame:
    """Older form of ``orders_fact``: join the items, then group by the order."""
    buyers = users.select("user_id", "acquisition_channel", "city", "age_group")
    items = order_items.select("order_id", "order_item_id")
    return (
        orders.join(buyers, "user_id")
        .join(items, "order_id", "left")
        .groupBy(
            "order_id", "user_id", "created_at", "status", "payment_method",
            "total_amount", "discount_amount", "acquisition_channel",
            F.col("city").alias("user_city"), F.col("age_group").alias("user_age_group"),
        )
        .agg(F.count("order_item_id").cast("int").alias("items_count"))
    )


def order_items_fact(
    order_items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    days: Sequence[str] | None = None,
) -> DataFrame:
    day_orders = _slice(orders, "created_at", days).select(
        "order_id", "user_id", F.col("created_at").alias("order_created_at")
    )
    return named_items(order_items.join(day_orders, "order_id"), products, categories)


def named_items(placed: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Item facts of items that know their order's user and time."""
    rows = placed.join(products.select("product_id", "category_id"), "product_id")
    return _named_category(rows, categories).select(
        "order_item_id", "order_id", "order_created_at", "user_id", "product_id",
        "category_id", "category_name", F.col("quantity").cast("smallint").alias("quantity"),
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)").alias("line_revenue"),
    )


def payments_fact(payments: DataFrame, days: Sequence[str] | None = None) -> DataFrame:
    """Payments by the day they were processed, which may be after the order day."""
    return _slice(payments, "processed_at", days).select(
        "payment_id", "order_id", "amount", "method", "status", "processed_at"
    )


def events_fact(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed events as delivered, repeated deliveries included; times keep whole seconds."""
    return events.select(
        "user_id", "session_id", "product_id", "event_type",
        whole_seconds("created_at").alias("created_at"), *keep,
    )


def without_repeats(events: DataFrame) -> DataFrame:
    """Optional: drop repeated deliveries of the same event."""
    return events.distinct()
