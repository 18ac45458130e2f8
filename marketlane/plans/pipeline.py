"""End-to-end runs: raw day partitions -> core and quarantine -> facts and marts.

``load_core`` and ``load_facts`` take any number of days.  One day is the daily
run; all days at once is the backfill, which gives the same tables as daily
runs in order because facts only see keys that arrived by their own day.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlane.functions.dates import in_days, not_expired
from marketlane.operators import quality
from marketlane.operators.classify import first_seen, skew_ready, unknown_keys
from marketlane.operators.copies import latest_version
from marketlane.operators.upsert import only_keys_of
from marketlane.plans import facts, history, marts, promote
from marketlane.schemas import DIMENSIONS, EVENT_RETENTION_MONTHS, FACTS, LOAD_AUDIT, columns_of, stored_layouts
from marketlane.session import hot_keys_split, in_small_splits
from marketlane.sinks import tables as sinks
from marketlane.sources import landing, storage

LAYOUTS = stored_layouts()


@dataclass(frozen=True)
class Warehouse:
    """Tables below one root folder that all executors can reach."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def has(self, name: str) -> bool:
        return storage.exists(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        """A table by its fixed layout, so an empty one can be read too."""
        return self.spark.read.schema(LAYOUTS[name]).parquet(self.path(name))

    def slices(self, name: str, days: Sequence[str], column: str = "_source_date") -> DataFrame:
        """The table's partitions of the given days, read by their folders: the plan knows how much that is."""
        there = set(storage.children(self.spark, self.path(name)))
        found = [f"{self.path(name)}/{column}={d}" for d in days if f"{column}={d}" in there]
        if not found:
            return self.read(name).where(F.lit(False))
        return self.spark.read.schema(LAYOUTS[name]).option("basePath", self.path(name)).parquet(*found)

    # Dimensions are stored as deliveries; the current state is folded on read.
    def deliveries(self, entity: str, until: str | None = None) -> DataFrame:
        rows = self.read(f"core/{entity}_deliveries")
        return rows.where(F.col("_source_date") <= F.lit(until).cast("date")) if until else rows

    def categories(self) -> DataFrame:
        return promote.promote_categories(self.deliveries("categories"))

    def users(self) -> DataFrame:
        return promote.promote_users(self.deliveries("users"))

    def products(self) -> DataFrame:
        return promote.promote_products(self.deliveries("products"))

    def core(self) -> dict[str, DataFrame]:
        return {
            "categories": self.categories(), "users": self.users(), "products": self.products(),
            **{t: self.read(f"core/{t}") for t in FACTS},
        }

    def orders_then(self) -> DataFrame:
        """``orders_fact`` with the buyer's attributes as of the order."""
        return history.orders_then(self.read("facts/orders_fact"), history.user_versions(self.deliveries("users")))

    def items_then(self) -> DataFrame:
        """``order_items_fact`` with the product's attributes as of the order."""
        return history.items_then(self.read("facts/order_items_fact"), history.product_versions(self.deliveries("products")))

    def dim(self, table: str) -> DataFrame:
        """Current version of each row of ``users_dim`` or ``products_dim``."""
        return latest_version(self.read(f"facts/{table}"), [f"{table[:-5]}_id"], "updated_at")


def _in_days(rows: DataFrame, days: Sequence[str], column: str = "_source_date") -> DataFrame:
    return rows.where(F.col(column).isin([datetime.fromisoformat(d).date() for d in days]))


def _covers_all(wh: Warehouse, days: Sequence[str]) -> bool:
    """Do the given days make up the whole history?  Answered by the directory listing."""
    tables = ("users_deliveries", "products_deliveries", *FACTS)
    names = [n for e in tables for n in storage.children(wh.spark, wh.path(f"core/{e}"))]
    return {n.removeprefix("_source_date=") for n in names if "=" in n} <= set(days)


def _cut(wh: Warehouse, known: DataFrame, rows: DataFrame, key: str, days: Sequence[str]) -> DataFrame:
    """Known rows whose key occurs in ``rows``; when all days are loaded nothing would be cut."""
    return known if _covers_all(wh, days) else only_keys_of(known, rows, key)


def _outside(wh: Warehouse, table: str, key: str, days: Sequence[str]) -> DataFrame | None:
    """Keys that slices other than ``days`` already hold."""
    if not wh.has(f"core/{table}") or _covers_all(wh, days):
        return None
    rows = wh.read(f"core/{table}")
    return rows.where(~F.col("_source_date").isin([datetime.fromisoformat(d).date() for d in days])).select(key)


def _load_dimensions(wh: Warehouse, raw: str, days: Sequence[str], run_time: datetime, run_id: str, uuid_ids: bool) -> None:
    typed = {
        "categories": promote.type_categories,
        "users": lambda rows: promote.type_users(rows, uuid_ids),
        "products": lambda rows: promote.type_products(rows, uuid_ids),
    }
    for entity in DIMENSIONS:
        staged = landing.read_entity(wh.spark, raw, entity, run_time, run_id, days)
        checked = quality.enforce_rows(entity, typed[entity](staged))
        slices = [min(days)] if entity == "categories" else list(days)
        sinks.replace_slices(
            sinks.gathered(checked, len(slices), "_source_date"), wh.path(f"core/{entity}_deliveries"),
            ["_source_date"], slices, day="_source_date",
        )


def _require_parents(wh: Warehouse, days: Sequence[str]) -> None:
    """Category references of the new deliveries."""
    categories = wh.categories()
    quality.require_zero(
        quality.union_all(
            [
                quality.foreign_report("categories", categories, "parent_id", categories, "category_id"),
                quality.foreign_report(
                    "products", wh.slices("core/products_deliveries", days), "category_id", categories, "category_id"
                ),
            ]
        )
    )


@in_small_splits
def load_core(
    spark: SparkSession,
    raw: str,
    wh: Warehouse,
    days: Sequence[str],
    run_time: datetime,
    uuid_ids: bool = True,
) -> str:
    """Land, judge, promote and audit the given days.  Returns ``success`` or ``skipped``.

    Days without a directory are skipped.  Running days again replaces their slices.
    """
    days = sorted(set(days) & set(landing.day_partitions(spark, raw)))
    if not days:
        return "skipped"
    run_id = f"run-{uuid.uuid4().hex[:12]}"
    work = wh.path(f"_work/{run_id}")
    last = max(days)
    try:
        _remember_slices(wh, days)
        _load_dimensions(wh, raw, days, run_time, run_id, uuid_ids)
        _require_parents(wh, days)

        def kept(name: str, rows: DataFrame) -> DataFrame:
            sinks.overwrite(rows, f"{work}/{name}")
            return spark.read.schema(rows.schema).parquet(f"{work}/{name}")

        def land(table: str) -> DataFrame:
            # Part of the history is parsed once into columns, of which the key lookups below read
            # single ones.  The whole of it needs no lookups of that kind, so a copy would be read once.
            rows = landing.read_entity(spark, raw, table, run_time, run_id, days)
            return rows if _covers_all(wh, days) else kept(f"landed_{table}", rows)

        def judge(table: str, judged: DataFrame) -> DataFrame:
            # Judged once, then read by promotion, quarantine and audit, without what is the same in all rows of a run.
            rows = kept(table, judged.drop("_loaded_at", "_batch_id"))
            return landing.stamp(rows, F.col("_source_date"), run_time, run_id)

        def store(table: str, promotion: promote.Promotion) -> None:
            rows = quality.enforce_rows(table, promotion.accepted)
            sinks.replace_slices(
                sinks.gathered(rows, len(days), "_source_date"), wh.path(f"core/{table}"),
                ["_source_date"], days, day="_source_date",
            )

        def arrivals(entity: str, key: str, rows: DataFrame) -> DataFrame:
            delivered = wh.deliveries(entity, last).select(key, "_source_date")
            return first_seen(_cut(wh, delivered, rows, key, days), key)

        def unknown(key: str, rows: DataFrame, known: DataFrame) -> DataFrame:
            # Kept, so that its true size is known when the rows are looked up.
            return kept(f"unknown_{key}", unknown_keys(rows, key, known, key, "_source_date"))

        landed = {t: land(t) for t in FACTS}
        users = unknown("user_id", landed["orders"], arrivals("users", "user_id", landed["orders"]))
        judged = {"orders": judge("orders", promote.classify_orders(landed["orders"], None, unknown_users=users, keep=kept))}
        orders = promote.split_orders(judged["orders"], _outside(wh, "orders", "order_id", days), uuid_ids)
        store("orders", orders)

        arrived = promote.arrived_orders(wh.read("core/orders"))
        products = unknown("product_id", landed["order_items"], arrivals("products", "product_id", landed["order_items"]))
        item_orders = _cut(wh, arrived, landed["order_items"], "order_id", days)
        with hot_keys_split(spark):
            judged["order_items"] = judge(
                "order_items", promote.classify_items(landed["order_items"], None, item_orders, unknown_products=products, mark=True)
            )
        items = promote.split_items(
            judged["order_items"], _outside(wh, "order_items", "order_item_id", days), uuid_ids, kept
        )
        store("order_items", items)

        payment_orders = _cut(wh, arrived, landed["payments"], "order_id", days)
        unpaid = unknown("order_id", landed["payments"], payment_orders)
        judged["payments"] = judge("payments", promote.classify_payments(landed["payments"], None, unknown_orders=unpaid))
        payments = promote.split_payments(
            judged["payments"], _outside(wh, "payments", "payment_id", days), uuid_ids, kept
        )
        _require_single_payment(wh, payments.accepted, days)
        store("payments", payments)

        rejected = promote.quarantine_all(
            {"orders": orders.rejected, "order_items": items.rejected, "payments": payments.rejected}, run_time
        )
        sinks.replace_slices(
            sinks.gathered(rejected, len(days), "source_date"), wh.path("dq/rejected_rows"),
            ["source_date"], days, day="source_date",
        )
        _audit(wh, raw, judged, days, run_time, run_id)
        _gates(wh, raw, days)
    finally:
        storage.delete(spark, work)
    return "success"


def _require_single_payment(wh: Warehouse, accepted: DataFrame, days: Sequence[str]) -> None:
    """A second payment of an order, also against earlier slices, stops the run."""
    ids = accepted.select("order_id")
    paid = _outside(wh, "payments", "order_id", days)
    if paid is not None:
        ids = ids.unionByName(only_keys_of(paid, ids, "order_id"))
    quality.require_zero(quality.unique_report("payments", ids, "order_id"))


def _key_report(wh: Warehouse, table: str, days: Sequence[str]) -> DataFrame:
    """Primary keys of the new slices that occur twice, there or in earlier slices."""
    key = quality.CORE_RULES[table].unique[0]
    rows = wh.read(f"core/{table}")
    return quality.unique_report(table, _cut(wh, rows.select(key), wh.slices(f"core/{table}", days), key, days), key)


def _audit(wh: Warehouse, raw: str, judged: dict[str, DataFrame], days: Sequence[str], run_time: datetime, run_id: str) -> None:
    counts = quality.union_all(
        [
            quality.promotion_counts(rows, wh.slices(f"core/{t}", days), t)
            for t, rows in judged.items()
        ]
    )
    clock = F.lit(run_time.isoformat(sep=" ")).cast("timestamp_ntz")
    asked = wh.spark.createDataFrame(
        [(datetime.fromisoformat(ds).date(), t) for ds in days for t in judged], "source_date date, source_table string"
    )
    lines = quality.load_audit(counts, landing.read_manifest(wh.spark, raw, days), asked).withColumns(
        {
            "run_id": F.lit(run_id), "started_at": clock,
            "finished_at": F.current_timestamp().cast("timestamp_ntz"), "status": F.lit("success"),
        }
    )
    sinks.upsert_audit(lines.select(*columns_of(LOAD_AUDIT)), wh.path("dq/load_audit"), days)


def _gates(wh: Warehouse, raw: str, days: Sequence[str]) -> None:
    """Keys of the new rows, new items against their parents, then landed rows against the manifests."""
    quality.require_zero(quality.union_all([_key_report(wh, t, days) for t in FACTS]))
    items = wh.slices("core/order_items", days)
    parents = _cut(wh, wh.read("core/orders").select("order_id", "user_id"), items, "order_id", days)
    products = _cut(wh, wh.deliveries("products").select("product_id").distinct(), items, "product_id", days)
    quality.require_integrity(quality.integrity_counts(parents, items, products))
    audit = _in_days(wh.read("dq/load_audit"), days, "source_date")
    manifest = landing.read_manifest(wh.spark, raw, days).where(F.col("source_table").isin(list(FACTS)))
    quality.require_complete(audit, manifest, wh.path("dq/shortfalls"))


def check_core(wh: Warehouse) -> None:
    """All constraints over the whole core; meant for occasional full checks."""
    quality.require_zero(quality.constraint_report(wh.core()))


def require_core(wh: Warehouse) -> None:
    missing = [t for t in FACTS if not wh.has(f"core/{t}")]
    if missing:
        raise RuntimeError(f"core tables are missing, load core first: {missing}")


@in_small_splits
def load_facts(
    spark: SparkSession,
    raw: str,
    wh: Warehouse,
    days: Sequence[str],
    run_time: datetime,
) -> None:
    """Replace the fact slices of the given days, refresh their marts and log the run."""
    require_core(wh)
    days = sorted(days)
    with sinks.RunLog(spark, wh.path("ops/etl_log"), "core_to_facts", days[-1], run_time) as log:
        order_days = _write_facts(spark, raw, wh, days, run_time, log)
        refresh_marts(wh, sorted({*days, *order_days}))
        storage.delete(spark, wh.path(LEFT_SLICES))
        log.add("run_complete", "ALL", 0, 0.0)


def _write_facts(
    spark: SparkSession, raw: str, wh: Warehouse, days: Sequence[str], run_time: datetime, log: sinks.RunLog
) -> list[str]:
    order_days, payment_days = _affected_days(wh, days)
    categories = wh.categories()
    orders, items, payments = (wh.read(f"core/{t}") for t in FACTS)
    orders, items = _delivered_with(orders, items, order_days)
    sold = only_keys_of(items, orders.where(in_days("created_at", order_days)), "order_id")
    stocked = _cut(wh, wh.deliveries("products"), sold, "product_id", days)
    products = skew_ready(promote.promote_products(stocked))
    buyers = _cut(wh, wh.deliveries("users"), orders.where(in_days("created_at", order_days)), "user_id", days)
    users = skew_ready(promote.promote_users(buyers))
    stamp = F.lit(run_time.isoformat(sep=" ")).cast("timestamp_ntz").alias("updated_at")
    whole = _covers_all(wh, days)  # then every item counts, and none is looked for by its order
    placed = orders.where(in_days("created_at", order_days))

    def changed(entity: str) -> DataFrame:
        # Only keys that arrived in these days can have a new version.
        rows = wh.deliveries(entity)
        return _cut(wh, rows, wh.slices(f"core/{entity}_deliveries", days), f"{entity[:-1]}_id", days)

    dims = {
        "users_dim": facts.users_dim(promote.promote_users(changed("users"))),
        "products_dim": facts.products_dim(promote.promote_products(changed("products")), categories),
    }
    for table, rows in dims.items():
        started = time.monotonic()
        written = sinks.append_counted(rows.select("*", stamp), wh.path(f"facts/{table}"))
        log.add("load_dims", table, written, time.monotonic() - started)

    plan = {
        "orders_fact": (facts.orders_fact(placed, users, items, None if whole else order_days), order_days),
        "order_items_fact": (
            facts.order_items_fact(items, orders, products, categories, order_days), order_days,
        ),
        "payments_fact": (facts.payments_fact(payments, payment_days), payment_days),
    }
    for table, (rows, slices) in plan.items():
        started = time.monotonic()
        written = sinks.write_fact(rows, wh.path(f"facts/{table}"), table, slices)
        log.add("load_facts", table, written, time.monotonic() - started)

    # Events skip core; a day without an event file leaves the event fact alone.
    have = landing.days_with(spark, raw, "events.csv", days)
    if have:
        started = time.monotonic()
        rows = facts.events_fact(landing.read_events_of_days(spark, raw, have), keep=("_source_date",))
        path = wh.path("facts/events_fact")
        written = sinks.write_fact(rows, path, "events_fact", have, day="_source_date")
        log.add("load_events", "events_fact", written, time.monotonic() - started)
    return order_days


LEFT_SLICES = "ops/left_slices"


def _remember_slices(wh: Warehouse, days: Sequence[str]) -> None:
    """Note the fact slices of the core rows that the run is about to replace.

    A row that the new delivery no longer holds leaves its slice stale; the note
    stays until ``load_facts`` has refreshed the slice, also in a later run.
    """
    if all(wh.has(f"core/{t}") for t in FACTS):
        sinks.append(_fact_days(wh, days), wh.path(LEFT_SLICES))


def _delivered_with(orders: DataFrame, items: DataFrame, order_days: list[str]) -> tuple[DataFrame, DataFrame]:
    """Orders and items without the deliveries that hold nothing of the given order days.

    One look at two columns of the orders finds the span of their deliveries; an
    item never arrives before its order, so the span's start holds for items too.
    """
    day = F.col("_source_date")
    span = orders.where(in_days("created_at", order_days)).agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    if span["first"] is None:
        return orders.where(F.lit(False)), items.where(F.lit(False))
    return orders.where(day.between(span["first"], span["last"])), items.where(day >= span["first"])


def _affected_days(wh: Warehouse, days: Sequence[str]) -> tuple[list[str], list[str]]:
    """Fact slices to refresh: those of the rows delivered in ``days`` and those that replaced rows have left."""
    rows = _fact_days(wh, days)
    if wh.has(LEFT_SLICES):
        rows = rows.unionByName(wh.spark.read.schema(rows.schema).parquet(wh.path(LEFT_SLICES)))
    found = rows.distinct().collect()
    listed = lambda kind: sorted({*days, *(r.day.isoformat() for r in found if r.kind == kind)})
    return listed("order"), listed("payment")


def _fact_days(wh: Warehouse, days: Sequence[str]) -> DataFrame:
    """``day, kind``: order days and payment days of the core rows delivered in ``days``.

    Rows mostly belong to their delivery day; late items and payments past
    midnight reach other slices.  The result is one entry per calendar day.
    """
    placed = wh.slices("core/orders", days)
    if not _covers_all(wh, days):  # else every order is among them
        placed = placed.unionByName(only_keys_of(wh.read("core/orders"), wh.slices("core/order_items", days), "order_id"))
    order_days = placed.select(F.to_date("created_at").alias("day"))
    payment_days = wh.slices("core/payments", days).select(F.to_date("processed_at").alias("day"))
    return (
        order_days.withColumn("kind", F.lit("order"))
        .unionByName(payment_days.withColumn("kind", F.lit("payment")))
        .where("day IS NOT NULL")
        .distinct()
    )


def refresh_marts(wh: Warehouse, days: Sequence[str]) -> None:
    """Recompute the partial mart rows of the given fact slices from the facts themselves."""

    def refresh(mart: str, fact: str, build) -> None:
        if not wh.has(f"facts/{fact}"):
            return
        rows = _in_days(wh.read(f"facts/{fact}"), days, "ds")
        sinks.replace_slices(sinks.gathered(build(rows), len(days), "ds"), wh.path(f"marts/{mart}"), ["ds"], days)

    refresh("daily_gmv", "orders_fact", lambda r: marts.daily_gmv(r, "ds"))
    refresh("category_revenue_daily", "order_items_fact", lambda r: marts.category_revenue_daily(r, "ds"))
    refresh("user_category_first_buy", "order_items_fact", lambda r: marts.user_category_first_buy(r, "ds"))
    refresh("funnel_daily", "events_fact", lambda r: marts.funnel_daily(r, "ds"))
    refresh("session_funnel_cells", "events_fact", lambda r: marts.session_funnel_cells(r, "ds"))


def live_events(wh: Warehouse, as_of: str) -> DataFrame:
    """Events that retention still keeps on the given day."""
    return wh.read("facts/events_fact").where(not_expired("created_at", as_of, EVENT_RETENTION_MONTHS))


def expire_events(wh: Warehouse, as_of: str) -> list[str]:
    """Drop the month partitions whose every event is past retention; returns their names.

    Partitions follow the delivery day and events do not postdate it, so a month
    can go once retention has passed its last day.
    """
    limit = datetime.fromisoformat(as_of)
    last_kept = limit.year * 12 + limit.month - 1 - EVENT_RETENTION_MONTHS
    dropped = []
    for name in storage.children(wh.spark, wh.path("facts/events_fact")):
        if name.startswith("month="):
            yyyymm = int(name.removeprefix("month="))
            if yyyymm // 100 * 12 + yyyymm % 100 - 1 < last_kept:
                storage.delete(wh.spark, wh.path(f"facts/events_fact/{name}"))
                dropped.append(name)
    return dropped


def run_days(spark: SparkSession, raw: str, wh: Warehouse, days: Sequence[str], run_time: datetime, uuid_ids: bool = True) -> str:
    status = load_core(spark, raw, wh, days, run_time, uuid_ids)
    if status == "success":
        load_facts(spark, raw, wh, days, run_time)
    return status


def backfill(spark: SparkSession, raw: str, wh: Warehouse, run_time: datetime, uuid_ids: bool = True) -> str:
    """Every day that has a partition, from the first one found."""
    return run_days(spark, raw, wh, landing.day_partitions(spark, raw), run_time, uuid_ids)
