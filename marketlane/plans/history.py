"""Facts with the attributes that were valid at their own time, next to today's.

``facts`` denormalises with the current state of users and products.  Here every
delivery that changed something is a version, valid from the start of the day it arrived.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlane.operators.versions import change_points, valid_at

USER_COLUMNS = ("acquisition_channel", "city", "age_group")
PRODUCT_COLUMNS = ("name", "category_id", "price", "cost_price")


def _from_arrival(deliveries: DataFrame) -> DataFrame:
    return deliveries.withColumn("valid_from", F.col("_source_date").cast("timestamp_ntz"))


def user_versions(deliveries: DataFrame) -> DataFrame:
    return change_points(_from_arrival(deliveries), "user_id", "valid_from", USER_COLUMNS)


def product_versions(deliveries: DataFrame) -> DataFrame:
    return change_points(_from_arrival(deliveries), "product_id", "valid_from", PRODUCT_COLUMNS)


def orders_then(orders: DataFrame, versions: DataFrame) -> DataFrame:
    """Orders with ``then_acquisition_channel``, ``then_city`` and ``then_age_group``."""
    return valid_at(orders, versions, "user_id", "created_at", "valid_from", USER_COLUMNS, "then_")


def items_then(items_fact: DataFrame, versions: DataFrame) -> DataFrame:
    """Item facts with the product's name, category and prices at the order's time, and the margin on them."""
    found = valid_at(items_fact, versions, "product_id", "order_created_at", "valid_from", PRODUCT_COLUMNS, "then_")
    margin = F.col("quantity") * (F.col("then_price") - F.col("then_cost_price"))
    return found.withColumn("then_margin", margin.cast("decimal(18,2)"))
