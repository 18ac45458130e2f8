"""Landing to core: typed promotion, quarantine and key conflicts.

With ``as_of=True`` a fact only sees dimension keys and orders that arrived on
or before its own day.  That makes one set-based job over all days equal to
ordered daily runs.  With ``as_of=False`` the input is one load.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from marketlane.functions.columns import (
    blank_to_null,
    canonical_uuid,
    decimal_or_zero,
    int_from_text,
    row_json,
)
from marketlane.operators.classify import first_reason, lookup_key, lookup_unknown
from marketlane.operators.copies import FIRST, SAME_RUN, copied_keys, first_per_key, mark_copies, mark_first, part_by_copies
from marketlane.operators.quality import union_all
from marketlane.operators.upsert import MUTABLE_COLUMNS, not_in, upsert_by_policy
from marketlane.schemas import LANDING_COLUMNS, META_COLUMNS

NULL_USER = "null_user_id"
ORPHAN_USER = "orphan_user"
DUPLICATE_PK = "duplicate_pk"
NULL_PRODUCT = "null_product_id"
ORPHAN_PRODUCT = "orphan_product"
NEGATIVE_QUANTITY = "negative_quantity"
ORPHAN_ORDER = "orphan_order"


#: Stores a small frame under a name and reads it back, so that its true size is known when it is joined.
Keep = Callable[[str, DataFrame], DataFrame]


@dataclass(frozen=True)
class Promotion:
    """Accepted rows (typed, with ``_source_date``) and rejected landing rows with a reason."""

    accepted: DataFrame
    rejected: DataFrame


# Core defaults; they apply to a column the delivery leaves out, not to a given NULL.
DEFAULTS = {
    "users": {"is_active": "true"},
    "products": {"is_available": "true"},
    "orders": {"discount_amount": "0"},
}


def fill_omitted(staged: DataFrame, entity: str) -> DataFrame:
    """Landing rows with every column of the entity, defaulted where it was left out."""
    defaults = DEFAULTS.get(entity, {})
    missing = [c for c in LANDING_COLUMNS[entity] if c not in staged.columns]
    return staged.withColumns({c: F.lit(defaults.get(c)).cast("string") for c in missing})


def _id(column: str, uuid_ids: bool) -> Column:
    return (canonical_uuid(column) if uuid_ids else F.col(column)).alias(column)


# ---- dimensions -----------------------------------------------------------


def type_categories(staged: DataFrame) -> DataFrame:
    return staged.select(
        int_from_text("category_id").alias("category_id"),
        "name",
        int_from_text("parent_id").alias("parent_id"),
        "_source_date",
    )


def type_users(staged: DataFrame, uuid_ids: bool = True) -> DataFrame:
    return staged.select(
        _id("user_id", uuid_ids), "email", "full_name",
        F.col("registration_date").cast("date").alias("registration_date"),
        "acquisition_channel", "city", "age_group",
        F.col("is_active").cast("boolean").alias("is_active"),
        "_source_date",
    )


def type_products(staged: DataFrame, uuid_ids: bool = True) -> DataFrame:
    return staged.select(
        _id("product_id", uuid_ids), "name",
        int_from_text("category_id").alias("category_id"),
        F.col("price").cast("decimal(12,2)").alias("price"),
        F.col("cost_price").cast("decimal(12,2)").alias("cost_price"),
        F.col("rating").cast("decimal(3,2)").alias("rating"),
        F.col("is_available").cast("boolean").alias("is_available"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        "_source_date",
    )


def promote_categories(versions: DataFrame) -> DataFrame:
    """Insert if absent: the first delivery of a category stays."""
    return upsert_by_policy(versions, "category_id", MUTABLE_COLUMNS["categories"])


def promote_users(versions: DataFrame) -> DataFrame:
    return upsert_by_policy(versions, "user_id", MUTABLE_COLUMNS["users"])


def promote_products(versions: DataFrame) -> DataFrame:
    return upsert_by_policy(versions, "product_id", MUTABLE_COLUMNS["products"])


def plain_dimension(typed: DataFrame) -> DataFrame:
    """One-time insert without conflict handling; repeated keys show up in the key check."""
    return typed.drop("_source_date")


# ---- facts ----------------------------------------------------------------


def _arrival(as_of: bool) -> str | None:
    return "_source_date" if as_of else None


def _looked_up(rows: DataFrame, column: str, out: str, known: DataFrame | None, unknown: DataFrame | None, as_of: bool) -> DataFrame:
    """Add boolean ``out`` from the known keys, or from the stored ``unknown_keys`` of the same rows."""
    if unknown is not None:
        return lookup_unknown(rows, column, unknown, out, "_source_date")
    return lookup_key(rows, column, known, column, out, _arrival(as_of))


def classify_orders(
    staged: DataFrame,
    users: DataFrame | None,
    as_of: bool = True,
    unknown_users: DataFrame | None = None,
    keep: Keep | None = None,
) -> DataFrame:
    """Landing rows with ``reject_reason`` and ``copy_state``.

    Only rows that pass the user rules compete for the order id.  ``unknown_users``
    holds ``user_id, _source_date`` that are not known; ``users`` is then not read.
    With ``keep`` only rows whose order id occurs several times are ranked.
    """
    known = _looked_up(staged, "user_id", "_has_user", users, unknown_users, as_of)
    rules = first_reason(
        [(NULL_USER, F.col("user_id").isNull()), (ORPHAN_USER, ~F.col("_has_user"))]
    )
    judged = known.withColumn("reject_reason", rules).drop("_has_user")
    clean = F.col("reject_reason").isNull()
    alone, several = None, judged
    if keep is not None:
        alone, several = part_by_copies(judged, "order_id", keep("copied_orders", copied_keys(judged.where(clean), "order_id")))
    marked = mark_copies(
        several,
        key=["order_id"],
        run=["_source_date"] if as_of else [],
        order_by=["_loaded_at", "created_at"],
        eligible=clean,
    )
    if alone is not None:
        marked = marked.unionByName(alone.withColumn("copy_state", F.when(clean, FIRST)))
    duplicate = F.when(F.col("copy_state") == SAME_RUN, DUPLICATE_PK)
    return marked.withColumn("reject_reason", F.coalesce("reject_reason", duplicate))


def type_orders(rows: DataFrame, uuid_ids: bool = True) -> DataFrame:
    return rows.select(
        _id("order_id", uuid_ids), _id("user_id", uuid_ids),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        "status", "payment_method",
        F.col("total_amount").cast("decimal(12,2)").alias("total_amount"),
        decimal_or_zero("discount_amount").alias("discount_amount"),
        blank_to_null("promo_code").alias("promo_code"),
        "_source_date",
    )


def classify_items(
    staged: DataFrame,
    products: DataFrame | None,
    orders: DataFrame,
    as_of: bool = True,
    unknown_products: DataFrame | None = None,
    mark: bool = False,
) -> DataFrame:
    """Landing rows with ``reject_reason``.  ``orders`` holds ``order_id, first_ds``.

    ``unknown_products`` holds ``product_id, _source_date`` that are not known; ``products`` is then not read.
    With ``mark`` rows also tell whether they are ``first_of_order``, the first accepted one of their id in their
    order: that is seen where the rows meet their orders, and later only ids have to be compared between orders.
    """
    rows = _looked_up(staged, "product_id", "_has_product", products, unknown_products, as_of)
    rows = lookup_key(rows, "order_id", orders, "order_id", "_has_order", _arrival(as_of), probe=mark)
    rules = [
        (NULL_PRODUCT, F.col("product_id").isNull()),
        (ORPHAN_PRODUCT, ~F.col("_has_product")),
        (NEGATIVE_QUANTITY, F.col("quantity").cast("int") <= 0),
        (ORPHAN_ORDER, ~F.col("_has_order")),
    ]
    judged = rows.withColumn("reject_reason", first_reason(rules)).drop("_has_product", "_has_order")
    if mark:
        clean = F.col("reject_reason").isNull()
        judged = mark_first(judged, "_probe", "order_item_id", WINNER_ORDER, clean, "first_of_order").drop("_probe")
    return judged


def type_items(rows: DataFrame, uuid_ids: bool = True) -> DataFrame:
    return rows.select(
        _id("order_item_id", uuid_ids), _id("order_id", uuid_ids), _id("product_id", uuid_ids),
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast("decimal(12,2)").alias("unit_price"),
        "_source_date",
    )


def classify_payments(
    staged: DataFrame, orders: DataFrame | None, as_of: bool = True, unknown_orders: DataFrame | None = None
) -> DataFrame:
    """Landing rows with ``reject_reason``; of ``orders`` and ``unknown_orders`` one is read, as for items."""
    rows = _looked_up(staged, "order_id", "_has_order", orders, unknown_orders, as_of)
    rule = first_reason([(ORPHAN_ORDER, ~F.col("_has_order"))])
    return rows.withColumn("reject_reason", rule).drop("_has_order")


def type_payments(rows: DataFrame, uuid_ids: bool = True) -> DataFrame:
    return rows.select(
        _id("payment_id", uuid_ids), _id("order_id", uuid_ids),
        F.col("amount").cast("decimal(12,2)").alias("amount"),
        "method", "status",
        F.col("processed_at").cast("timestamp_ntz").alias("processed_at"),
        "_source_date",
    )


def arrived_orders(core_orders: DataFrame) -> DataFrame:
    """Core order keys in the form the lookups take."""
    return core_orders.select("order_id", F.col("_source_date").alias("first_ds"))


def _rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reject_reason").isNotNull())


WINNER_ORDER = ["_source_date", "_loaded_at"]


def _winners(classified: DataFrame, key: str, uuid_ids: bool, keep: Keep | None = None) -> DataFrame:
    """First accepted row per key; the others are dropped silently, as on a key conflict.

    Spellings of one UUID are one key.  With ``keep`` only rows whose key occurs several times are ranked.
    """
    clean = classified.where(F.col("reject_reason").isNull()).drop("reject_reason").withColumn(key, _id(key, uuid_ids))
    if keep is None:
        return first_per_key(clean, [key], WINNER_ORDER)
    alone, several = part_by_copies(clean, key, keep(f"copied_{key}", copied_keys(clean, key)))
    return alone.unionByName(first_per_key(several, [key], WINNER_ORDER))


def _without_known(rows: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    return rows if existing is None else not_in(rows, existing, key)


def split_orders(
    classified: DataFrame, existing: DataFrame | None = None, uuid_ids: bool = True
) -> Promotion:
    """``existing`` holds the order ids that earlier runs already promoted.

    Copies are told apart by the text of the id, as delivered; spellings of one
    UUID then compete for the key without being rejected.
    """
    winners = classified.where(F.col("copy_state") == FIRST)
    if uuid_ids:
        winners = _winners(winners, "order_id", uuid_ids)
    accepted = _without_known(type_orders(winners, uuid_ids), existing, "order_id")
    return Promotion(accepted, _rejected(classified).drop("copy_state"))


def split_items(
    classified: DataFrame, existing: DataFrame | None = None, uuid_ids: bool = True, keep: Keep | None = None
) -> Promotion:
    """With ``keep`` the rows are marked, and only ids of marked rows are compared between orders."""
    rows = classified
    if keep is not None:
        rows, classified = classified.where("first_of_order").drop("first_of_order"), classified.drop("first_of_order")
    accepted = type_items(_winners(rows, "order_item_id", uuid_ids, keep), uuid_ids)
    return Promotion(_without_known(accepted, existing, "order_item_id"), _rejected(classified))


def split_payments(
    classified: DataFrame, existing: DataFrame | None = None, uuid_ids: bool = True, keep: Keep | None = None
) -> Promotion:
    accepted = type_payments(_winners(classified, "payment_id", uuid_ids, keep), uuid_ids)
    return Promotion(_without_known(accepted, existing, "payment_id"), _rejected(classified))


def quarantine(rejected: DataFrame, table: str, run_time: datetime) -> DataFrame:
    """Reason plus the full landing row as JSON."""
    return rejected.select(
        F.lit(table).alias("source_table"),
        F.col("_source_date").alias("source_date"),
        F.col("reject_reason").alias("reason"),
        row_json([*LANDING_COLUMNS[table], *META_COLUMNS]).alias("raw_data"),
        F.lit(run_time.isoformat(sep=" ")).cast("timestamp_ntz").alias("rejected_at"),
    )


def quarantine_all(rejected: dict[str, DataFrame], run_time: datetime) -> DataFrame:
    return union_all([quarantine(rows, table, run_time) for table, rows in rejected.items()])
