"""Named queries over whole pipeline runs, on top of the single-step catalog.

One run per session and source folder: all landing rows are written by entity
and monthly delivery, with manifests, then loaded by a backfill, and the last
delivery is loaded once more, which must change nothing.  The queries read the
warehouse that this leaves.  Order and shipping days are drawn together, forty to
one and in order, so that a run makes tens and not thousands of day slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marketlane.plans import marts, pipeline
from marketlane.plans.catalog import CHECKS, QUERIES, RUN_TIME, Work, portable
from marketlane.plans.catalog_sql import CTES, statement
from marketlane.schemas import FACT_SORT_KEY
from marketlane.session import small_splits
from marketlane.sinks import tables as sinks
from marketlane.sources import landing

FIRST_DAY, LAID_TO, DAYS_TO_ONE = "1992-01-01", "1999-10-15", 40
MONTH = "date_trunc('month', {0})::DATE"
# 2,600 days at 40 to 1 are in four months, a payment past midnight may be in a fifth; events are not folded, a year of them is few as well.
FEW_MONTHS = {"orders": 5, "order_items": 5, "payments": 5, "events": 12}
_RUNS: dict[tuple[str, str], pipeline.Warehouse] = {}

def _drawn_together(sql: str) -> str:
    for column in ("o_orderdate", "l_shipdate"):
        sql = sql.replace(column, f"(DATE '{LAID_TO}' + (date_diff('day', DATE '{FIRST_DAY}', {column}) // {DAYS_TO_ONE})::INT)")
    return sql


class Close(Work):
    """The source tables with order and shipping days drawn together."""

    def table(self, name: str) -> DataFrame:
        rows = super().table(name)
        for column in {"o_orderdate", "l_shipdate"} & set(rows.columns):
            days = F.datediff(F.to_date(column), F.lit(FIRST_DAY).cast("date"))
            rows = rows.withColumn(column, F.date_add(F.lit(LAID_TO).cast("date"), F.floor(days / DAYS_TO_ONE).cast("int")))
        return rows


# The same definitions over monthly deliveries, and facts built from promoted rows.
MONTHLY = {
    name: f"SELECT * REPLACE ({MONTH.format('_source_date')} AS _source_date) FROM ({_drawn_together(body)})"
    if name.startswith("s_")
    else _drawn_together(body)
    for name, body in CTES.items()
} | {
    "g_days": """
        SELECT DISTINCT _source_date AS source_date FROM (
          SELECT _source_date FROM s_users UNION ALL SELECT _source_date FROM s_products UNION ALL SELECT _source_date FROM s_orders
          UNION ALL SELECT _source_date FROM s_order_items UNION ALL SELECT _source_date FROM s_payments
          UNION ALL SELECT date_trunc('month', created_at)::DATE FROM f_events)""",
    "g_orders": """
        SELECT o.*, (SELECT count(*) FROM p_items i WHERE i.order_id = o.order_id) AS items_count,
               u.acquisition_channel, u.city AS user_city, u.age_group AS user_age_group
        FROM p_orders o, d_users u WHERE u.user_id = o.user_id""",
    "g_items": """
        SELECT order_item_id, p_items.order_id, p_orders.created_at AS order_created_at, p_orders.user_id, p_items.product_id,
               coalesce(d_products.category_id, 0) AS category_id, p_items.quantity, p_items.unit_price
        FROM p_items INNER JOIN p_orders USING (order_id) INNER JOIN d_products USING (product_id)""",
}


def land_everything(w: Work, root: str) -> None:
    """Every landing row as monthly deliveries in the entity layout, with the manifests that announce them."""
    month = lambda c: F.trunc(c, "month")
    frames = {e: (w.staged(e), month("_source_date")) for e in ("categories", "users", "products", "orders", "order_items", "payments")}
    frames["events"] = (w.raw_events, month("created_at"))
    for entity, (rows, day) in frames.items():
        sinks.write_landing(rows, root, entity, day, FEW_MONTHS.get(entity), "gzip")
    sinks.write_manifests(sinks.manifest_counts(frames), root)


def loaded(w: Work) -> pipeline.Warehouse:
    key = (w.spark.sparkContext.applicationId, w.folder)
    if key not in _RUNS:
        root, wh = w.folder_for("landing"), pipeline.Warehouse(w.spark, w.folder_for("warehouse"))
        with small_splits(w.spark):
            land_everything(w, root)
        pipeline.backfill(w.spark, root, wh, RUN_TIME, uuid_ids=False)
        pipeline.run_days(w.spark, root, wh, landing.day_partitions(w.spark, root)[-1:], RUN_TIME, uuid_ids=False)
        _RUNS[key] = wh
    return _RUNS[key]


def run_query(name: str, sql: str):
    def register(fn):
        QUERIES[name] = lambda spark, folder: portable(fn(loaded(Close(spark, folder))))
        CHECKS[name] = statement(sql.strip(), MONTHLY)
        return fn

    return register


@run_query(
    "run_core_orders",
    """SELECT order_id, user_id, created_at::VARCHAR AS created_at, status, payment_method, total_amount::DOUBLE AS total_amount,
              discount_amount::DOUBLE AS discount_amount, promo_code, _source_date::VARCHAR AS _source_date FROM p_orders""",
)
def _(wh: pipeline.Warehouse) -> DataFrame:
    return wh.read("core/orders")


@run_query(
    "run_core_order_items",
    """SELECT order_item_id, order_id, product_id, quantity::BIGINT AS quantity, unit_price::DOUBLE AS unit_price,
              _source_date::VARCHAR AS _source_date FROM p_items""",
)
def _(wh: pipeline.Warehouse) -> DataFrame:
    return wh.read("core/order_items")


@run_query(
    "run_core_payments",
    """SELECT payment_id, order_id, amount::DOUBLE AS amount, method, status, processed_at::VARCHAR AS processed_at,
              _source_date::VARCHAR AS _source_date FROM p_payments""",
)
def _(wh: pipeline.Warehouse) -> DataFrame:
    return wh.read("core/payments")


@run_query(
    "run_core_users",
    """SELECT user_id, email, full_name, registration_date::VARCHAR AS registration_date, acquisition_channel, city, age_group,
              is_active::BOOLEAN AS is_active FROM d_users""",
)
def _(wh: pipeline.Warehouse) -> DataFrame:
    return wh.users().drop("first_ds")


@run_query(
    "run_quarantine",
    """SELECT source_table, source_date::VARCHAR AS source_date, reason, count(*) AS rows_rejected FROM q_all GROUP BY 1, 2, 3""",
)
def _(wh: pipeline.Warehouse) -> DataFrame:
    return wh.read("dq/rejected_rows").groupBy("source_table", "source_date", "reason").agg(F.count("*").alias("rows_rejected"))


@run_query(
    "run_load_audit",
    """SELECT source_date::VARCHAR AS source_date, source_table, coalesce(rows_staging, 0) AS rows_staging,
              coalesce(rows_promoted, 0) AS rows_promoted, coalesce(rows_rejected, 0) AS rows_rejected,
              coalesce(rows_conflict_skipped, 0) AS rows_conflict_skipped, rows_staging AS rows_manifest, 'success' AS status
       FROM g_days CROSS JOIN (SELECT unnest(['orders', 'order_items', 'payments']) AS source_table)
       LEFT JOIN n_audit USING (source_date, source_table)""",
)
def _(wh: pipeline.Warehouse) -> DataFrame:
    """One line per delivery and table, zeros included; the manifest announced what was staged."""
    return wh.read("dq/load_audit").select(
        "source_date", "source_table", "rows_staging", "rows_promoted", "rows_rejected", "rows_conflict_skipped", "rows_manifest", "status"
    )


@run_query(
    "run_orders_fact",
    """SELECT order_id, user_id, created_at::VARCHAR AS created_at, status, payment_method, total_amount::DOUBLE AS total_amount,
              discount_amount::DOUBLE AS discount_amount, items_count, acquisition_channel, user_city, user_age_group,
              created_at::DATE::VARCHAR AS ds FROM g_orders""",
)
def _(wh: pipeline.Warehouse) -> DataFrame:
    return wh.read("facts/orders_fact").drop("month")


@run_query(
    "run_order_items_fact",
    """SELECT order_item_id, order_id, order_created_at::VARCHAR AS order_created_at, user_id, product_id,
              category_id::BIGINT AS category_id, quantity::BIGINT AS quantity,
              (quantity * unit_price)::DECIMAL(18,2)::DOUBLE AS line_revenue FROM g_items""",
)
def _(wh: pipeline.Warehouse) -> DataFrame:
    return wh.read("facts/order_items_fact").select(
        "order_item_id", "order_id", "order_created_at", "user_id", "product_id", "category_id", "quantity", "line_revenue"
    )


@run_query(
    "run_daily_gmv",
    """SELECT created_at::DATE::VARCHAR AS day, sum(total_amount)::DOUBLE AS gmv, count(*) AS orders
       FROM g_orders WHERE status = 'completed' GROUP BY 1""",
)
def _(wh: pipeline.Warehouse) -> DataFrame:
    return marts.daily_gmv_merge(wh.read("marts/daily_gmv")).select("day", "gmv", "orders")


@run_query(
    "run_events_fact",
    """SELECT date_trunc('month', created_at)::DATE::VARCHAR AS ds, event_type, count(*) AS events,
              count(DISTINCT session_id) AS sessions FROM f_events GROUP BY 1, 2""",
)
def _(wh: pipeline.Warehouse) -> DataFrame:
    rows = wh.read("facts/events_fact").groupBy("ds", "event_type")
    return rows.agg(F.count("*").alias("events"), F.countDistinct("session_id").alias("sessions"))


@run_query(
    "run_etl_log",
    """SELECT target_table, rows FROM (
         SELECT 'orders_fact' AS target_table, count(*) AS rows FROM g_orders
         UNION ALL SELECT 'order_items_fact', count(*) FROM g_items
         UNION ALL SELECT 'payments_fact', count(*) FROM p_payments
         UNION ALL SELECT 'events_fact', count(*) FROM f_events
         UNION ALL SELECT 'users_dim', count(*) FROM d_users
         UNION ALL SELECT 'products_dim', count(*) FROM d_products)""",
)
def _(wh: pipeline.Warehouse) -> DataFrame:
    """Rows that the backfill logged per table; the repeated delivery has logged its own, fewer."""
    logged = wh.read("ops/etl_log").where("target_table <> 'ALL' AND status = 'success'")
    return logged.groupBy("target_table").agg(F.max("rows").alias("rows"))


@run_query(
    "run_sorted_slices",
    """SELECT unnest(['order_items_fact', 'orders_fact', 'payments_fact']) AS table_name, 0::BIGINT AS out_of_order,
              unnest([(SELECT count(*) FROM g_items), (SELECT count(*) FROM g_orders), (SELECT count(*) FROM p_payments)]) AS rows""",
)
def _(wh: pipeline.Warehouse) -> DataFrame:
    """Rows of each fact that are below their predecessor in the same file."""
    parts = []
    for table in ("orders_fact", "order_items_fact", "payments_fact"):
        key = F.struct(*FACT_SORT_KEY[table])
        rows = wh.read(f"facts/{table}").select(
            key.alias("k"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")
        )
        before = F.lag("k").over(Window.partitionBy("file").orderBy("place"))
        counted = rows.withColumn("bad", F.coalesce(before > F.col("k"), F.lit(False)))
        parts.append(counted.agg(F.count_if("bad").alias("out_of_order"), F.count("*").alias("rows")).select(F.lit(table).alias("table_name"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
