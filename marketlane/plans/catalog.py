"""Named queries over the source tables, each with the SQL that checks it.

``@query(name, sql)`` registers a function of a ``Work``; ``sql=None`` marks
results that SQL cannot state (those only have tests).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marketlane.functions import columns as C, dates as D, sketches as S, states
from marketlane.operators import basket, cohorts, copies, funnel, funnel_state, heavy_hitters, numbering, quality, upsert
from marketlane.operators.classify import first_seen, lookup_key, skew_ready
from marketlane.plans import facts, history, marts, promote, reports
from marketlane.plans.catalog_sql import statement
from marketlane.session import new_folder
from marketlane.sinks import tables as sinks
from marketlane.sources import landing, relational
from marketlane.sources.shop_tables import Shop
from marketlane.streaming import audited, incremental, two_streams

RUN_TIME = datetime(2024, 2, 1)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


class Work(Shop):
    """Source tables plus the frames derived from them."""

    @cached_property
    def users_dim(self) -> DataFrame:
        return facts.users_dim(self.users)

    @cached_property
    def products_dim(self) -> DataFrame:
        return facts.products_dim(self.products, self.categories)

    @cached_property
    def orders_fact(self) -> DataFrame:
        return facts.orders_fact(self.orders, self.users, self.order_items)

    @cached_property
    def items_fact(self) -> DataFrame:
        return facts.order_items_fact(self.order_items, self.orders, self.products, self.categories)

    @cached_property
    def items_by_order(self) -> DataFrame:
        """``items_fact`` with the join's partitions as they are dealt, for steps that go on by order in the same task."""
        count = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = self.order_items.repartition(count, "order_id")
        return facts.order_items_fact(dealt, self.orders, self.products, self.categories)

    @cached_property
    def events_fact(self) -> DataFrame:
        return facts.events_fact(self.raw_events)

    # ---- promotion of the dirty landing rows ----

    @cached_property
    def core_users(self) -> DataFrame:
        return promote.promote_users(promote.type_users(self.staged("users"), uuid_ids=False))

    @cached_property
    def core_products(self) -> DataFrame:
        return promote.promote_products(promote.type_products(self.staged("products"), uuid_ids=False))

    @cached_property
    def core_categories(self) -> DataFrame:
        return promote.promote_categories(promote.type_categories(self.staged("categories")))

    @cached_property
    def user_keys(self) -> DataFrame:
        return first_seen(self.staged("users"), "user_id")

    @cached_property
    def product_keys(self) -> DataFrame:
        return first_seen(self.staged("products"), "product_id")

    @cached_property
    def judged_orders(self) -> DataFrame:
        return promote.classify_orders(self.staged("orders"), self.user_keys)

    @cached_property
    def order_promotion(self) -> promote.Promotion:
        return promote.split_orders(self.judged_orders, uuid_ids=False)

    @cached_property
    def order_keys(self) -> DataFrame:
        return skew_ready(promote.arrived_orders(self.order_promotion.accepted))

    @cached_property
    def judged_items(self) -> DataFrame:
        return promote.classify_items(self.staged("order_items"), self.product_keys, self.order_keys)

    @cached_property
    def item_promotion(self) -> promote.Promotion:
        return promote.split_items(self.judged_items, uuid_ids=False)

    @cached_property
    def judged_payments(self) -> DataFrame:
        return promote.classify_payments(self.staged("payments"), self.order_keys)

    @cached_property
    def payment_promotion(self) -> promote.Promotion:
        return promote.split_payments(self.judged_payments, uuid_ids=False)

    @property
    def promotions(self) -> dict[str, promote.Promotion]:
        return {
            "orders": self.order_promotion,
            "order_items": self.item_promotion,
            "payments": self.payment_promotion,
        }

    @cached_property
    def rejected(self) -> DataFrame:
        return promote.quarantine_all({t: p.rejected for t, p in self.promotions.items()}, RUN_TIME)

    @cached_property
    def audit(self) -> DataFrame:
        counts = [quality.promotion_counts(rows, self.winners(t), t) for t, rows in self.verdicts.items()]
        return quality.load_audit(quality.union_all(counts), self.announced)

    @cached_property
    def announced(self) -> DataFrame:
        """Manifest of the clean rows: ``source_date, source_table, rows_manifest``."""
        placed = self.order_items.join(self.orders.select("order_id", "created_at"), "order_id")
        wide = sinks.manifest_counts(
            {
                "orders": (self.orders, F.col("created_at")),
                "order_items": (placed, F.col("created_at")),
                "payments": (self.payments, F.col("processed_at")),
            }
        )
        missing = {e: F.lit(None).cast("bigint") for e in landing.COUNTED if e not in wide.columns}
        return landing.unpivot_counts(wide.withColumns(missing).withColumnRenamed("ds", "source_date"))

    def keep(self, label: str, rows: DataFrame) -> DataFrame:
        """Write a frame that is used several times to the shared folder and read it back."""
        path = self.folder_for(label)
        rows.write.parquet(path)
        return self.spark.read.parquet(path)

    def keep_judged(self, *tables: str) -> Work:
        """Judge every landing row once, whole; all that follows reads the written tables."""
        for name in tables or ("orders", "items", "payments"):
            setattr(self, f"judged_{name}", self.keep(f"judged_{name}", getattr(self, f"judged_{name}")))
        return self

    @cached_property
    def verdicts(self) -> dict[str, DataFrame]:
        """Per table what counting needs of the judged rows: ``id, _source_date, reject_reason``, written once.

        Orders go first and carry ``copy_state``; their winners are the keys that
        items and payments are judged by, so no full row is ever written.
        """
        columns = ["_source_date", "reject_reason"]
        orders = self.keep("verdicts", self.judged_orders.select(F.col("order_id").alias("id"), *columns, "copy_state"))
        first = orders.where(F.col("copy_state") == copies.FIRST).select(F.col("id").alias("order_id"), "_source_date")
        keys = promote.arrived_orders(first)
        items = promote.classify_items(
            self.staged("order_items").select("order_item_id", "order_id", "product_id", "quantity", "_source_date"),
            self.product_keys, keys,
        )
        payments = promote.classify_payments(
            self.staged("payments").select("payment_id", "order_id", "_source_date"), keys
        )
        return {
            "orders": orders,
            "order_items": self.keep("verdicts", items.select(F.col("order_item_id").alias("id"), *columns)),
            "payments": self.keep("verdicts", payments.select(F.col("payment_id").alias("id"), *columns)),
        }

    @property
    def rejects(self) -> DataFrame:
        """``source_table, source_date, reason`` of every rejected row."""
        rejected = [
            rows.where("reject_reason IS NOT NULL").select(
                F.lit(t).alias("source_table"), F.col("_source_date").alias("source_date"), F.col("reject_reason").alias("reason")
            )
            for t, rows in self.verdicts.items()
        ]
        return quality.union_all(rejected)

    @property
    def reject_counts(self) -> DataFrame:
        return quality.reject_summary(self.rejects)

    def winners(self, table: str) -> DataFrame:
        """``_source_date`` of each promoted row: an id goes to its first accepted day."""
        rows = self.verdicts[table]
        if table == "orders":
            return rows.where(F.col("copy_state") == copies.FIRST).select("_source_date")
        return rows.where("reject_reason IS NULL").groupBy("id").agg(F.min("_source_date").alias("_source_date")).drop("id")

    def streamed(self, name: str) -> Work:
        """Same tables with one of them as a file stream."""
        stream = (
            self.spark.readStream.schema(self.table(name).schema)
            .option("pathGlobFilter", f"{name}.parquet")
            .parquet(self.folder)
        )
        other = Work(self.spark, self.folder)
        other.table = lambda wanted: stream if wanted == name else self.table(wanted)
        return other

    def folder_for(self, label: str) -> str:
        return new_folder(self.spark, label)


def portable(rows: DataFrame) -> DataFrame:
    """Money as double, whole numbers as bigint, days and times as text."""
    out = []
    for f in rows.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return rows.select(*out)


def query(name: str, sql: str | None):
    def register(fn: Callable[[Work], DataFrame]):
        QUERIES[name] = lambda spark, folder: portable(fn(Work(spark, folder)))
        if sql is not None:
            CHECKS[name] = statement(sql.strip())
        return fn

    return register


# ---- business questions ---------------------------------------------------------


@query(
    "q1_gmv_daily",
    """SELECT day::VARCHAR AS day, gmv::DOUBLE AS gmv, orders, buyers,
              ((2 * (gmv * 100)::HUGEINT + orders) // (2 * orders))::DOUBLE / 100 AS aov FROM m_gmv ORDER BY day""",
)
def _(w: Work) -> DataFrame:
    return reports.gmv_by_day(marts.daily_gmv_exact(w.orders_fact))


@query(
    "q1_gmv_daily_from_states",
    "SELECT day::VARCHAR AS day, gmv::DOUBLE AS gmv, orders, true AS buyers_within_error FROM m_gmv",
)
def _(w: Work) -> DataFrame:
    exact = marts.daily_gmv_exact(w.orders_fact).select("day", F.col("buyers").alias("exact"))
    merged = marts.daily_gmv_merge(marts.daily_gmv(w.orders_fact)).join(exact, "day")
    near = F.abs(F.col("buyers") - F.col("exact")) <= 1 + 4 * S.HLL_ERROR * F.col("exact")
    return merged.select("day", "gmv", "orders", near.alias("buyers_within_error"))


@query(
    "q2_top_categories",
    """SELECT category_name, round(sum(revenue), 0)::DOUBLE AS revenue, sum(items_sold)::BIGINT AS items
       FROM m_category GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def _(w: Work) -> DataFrame:
    return reports.top_categories(marts.category_revenue_daily(w.items_fact))


@query(
    "q3_cohort_retention",
    "SELECT cohort::VARCHAR AS cohort, month_offset::BIGINT AS month_offset, users FROM x_retention ORDER BY 1, 2",
)
def _(w: Work) -> DataFrame:
    versions = w.users_dim.withColumn("updated_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    return reports.cohort_retention(reports.registration_cohorts(versions), w.orders_fact)


@query(
    "q4_session_funnel",
    "SELECT level::BIGINT AS level, count(*) AS sessions FROM w_session_levels GROUP BY 1 ORDER BY 1",
)
def _(w: Work) -> DataFrame:
    return reports.session_funnel(w.events_fact)


@query(
    "q5_promo_impact",
    """SELECT CASE WHEN discount_amount > 0 THEN 'промокод' ELSE 'без промо' END AS segment,
              count(*) AS orders, round(sum(total_amount)::DOUBLE / count(total_amount), 2) AS aov,
              round(sum(total_amount), 0)::DOUBLE AS gmv,
              round(sum(discount_amount)::DOUBLE / count(discount_amount), 2) AS avg_discount
       FROM f_orders WHERE status = 'completed' GROUP BY 1""",
)
def _(w: Work) -> DataFrame:
    return reports.promo_impact(w.orders_fact)


@query(
    "s2_market_basket",
    "SELECT cat_a, cat_b, together FROM b_pairs ORDER BY together DESC, cat_a, cat_b LIMIT 15",
)
def _(w: Work) -> DataFrame:
    return reports.market_basket(w.items_by_order)


@query(
    "s3_distinct_users",
    """SELECT count(DISTINCT user_id) AS exact, true AS combined_within_error, true AS hll12_within_error
       FROM f_events""",
)
def _(w: Work) -> DataFrame:
    counted = reports.distinct_three_ways(w.events_fact, "user_id")
    near = lambda c, e: F.abs(F.col(c) - F.col("exact")) <= 1 + 4 * e * F.col("exact")
    return counted.select(
        "exact",
        near("combined", 0.01).alias("combined_within_error"),
        near("hll12", S.HLL_ERROR).alias("hll12_within_error"),
    )


@query(
    "k1_kpi_card",
    """SELECT gmv::DOUBLE AS gmv, orders::BIGINT AS orders, round(gmv::DOUBLE / orders, 2) AS aov,
              round(purchases::DOUBLE / views, 4) AS conversion
       FROM (SELECT sum(gmv) AS gmv, sum(orders) AS orders FROM m_gmv),
            (SELECT sum(purchases) AS purchases, sum(views) AS views FROM m_funnel)""",
)
def _(w: Work) -> DataFrame:
    merged = marts.daily_gmv_merge(marts.daily_gmv(w.orders_fact))
    return reports.kpi_card(merged, marts.funnel_merge(marts.funnel_daily(w.events_fact)))


@query(
    "k2_payment_methods",
    """SELECT payment_method, count(*) AS orders, sum(total_amount)::DOUBLE AS gmv
       FROM f_orders WHERE status = 'completed' GROUP BY 1""",
)
def _(w: Work) -> DataFrame:
    return reports.by_payment_method(w.orders_fact)


@query(
    "k3_step_conversions",
    """SELECT day::VARCHAR AS day, views, carts, purchases,
              round(carts::DOUBLE / nullif(views, 0), 4) AS view_to_cart,
              round(purchases::DOUBLE / nullif(carts, 0), 4) AS cart_to_purchase FROM m_funnel""",
)
def _(w: Work) -> DataFrame:
    return reports.step_conversions(marts.funnel_merge(marts.funnel_daily(w.events_fact)))


@query(
    "k4_first_purchase_retention",
    "SELECT cohort::VARCHAR AS cohort, month_offset::BIGINT AS month_offset, users FROM x_retention_first ORDER BY 1, 2",
)
def _(w: Work) -> DataFrame:
    return reports.cohort_retention(reports.first_purchase_cohorts(w.orders_fact), w.orders_fact)


@query(
    "k5_retention_matrix",
    """SELECT g.cohort::VARCHAR AS cohort, 'm' || k AS month_column, coalesce(users, 0)::BIGINT AS users
       FROM (SELECT cohort, unnest(range(0, 1 + date_diff('month', (SELECT min(cohort) FROM x_cohorts),
                                                          (SELECT max(active_month) FROM x_activity)))) AS k
             FROM (SELECT DISTINCT cohort FROM x_retention)) g
       LEFT JOIN x_retention r ON r.cohort = g.cohort AND r.month_offset = k""",
)
def _(w: Work) -> DataFrame:
    """Every cell of the matrix as a row: cohort, name of the column, users."""
    groups = w.users_dim.select("user_id", D.month_start("registration_date").alias("cohort"))
    bought = cohorts.active_months(w.orders_fact.where("status = 'completed'"), "user_id", "created_at")
    offsets = cohorts.offset_span(groups, bought)
    matrix = cohorts.retention_matrix(reports.cohort_retention(groups, w.orders_fact), offsets)
    return matrix.unpivot(["cohort"], [f"m{k}" for k in offsets], "month_column", "users")


@query(
    "k5_retention_share",
    """SELECT cohort::VARCHAR AS cohort, month_offset::BIGINT AS month_offset, users, cohort_users,
              round(users * 100.0::DOUBLE / cohort_users, 2) AS pct
       FROM x_retention JOIN (SELECT cohort, count(*) AS cohort_users FROM x_cohorts GROUP BY 1) USING (cohort)""",
)
def _(w: Work) -> DataFrame:
    groups = w.users_dim.select("user_id", D.month_start("registration_date").alias("cohort"))
    return cohorts.retention_share(reports.cohort_retention(groups, w.orders_fact), groups)


@query(
    "k6_pipeline_health",
    """SELECT source_date::VARCHAR AS source_date, target_table, 'success' AS status, 1::BIGINT AS runs,
              rows, 0.0::DOUBLE AS seconds
       FROM (SELECT created_at::DATE AS source_date, 'events_fact' AS target_table, count(*) AS rows FROM f_events GROUP BY 1
             UNION ALL SELECT created_at::DATE, 'orders_fact', count(*) FROM f_orders GROUP BY 1)""",
)
def _(w: Work) -> DataFrame:
    path = w.folder_for("etl_log")
    for table, rows in {"events_fact": w.events_fact, "orders_fact": w.orders_fact}.items():
        counted = rows.groupBy(F.to_date("created_at").alias("source_date")).agg(F.count("*").alias("rows"))
        sinks.append(
            counted.select(
                F.lit(RUN_TIME.isoformat(sep=" ")).cast("timestamp_ntz").alias("ts"),
                F.lit("core_to_facts").alias("dag_id"), F.lit("load_facts").alias("task"),
                "source_date", F.lit(table).alias("target_table"), "rows",
                F.lit(0.0).cast("float").alias("seconds"), F.lit("success").alias("status"),
            ),
            path,
        )
    return reports.pipeline_health(w.spark.read.parquet(path))


@query(
    "k7_rejects_by_reason",
    "SELECT source_table, reason, count(*) AS rows_rejected FROM q_all GROUP BY 1, 2",
)
def _(w: Work) -> DataFrame:
    return w.rejects.groupBy("source_table", "reason").agg(F.count("*").alias("rows_rejected"))


@query(
    "k8_zero_sales_days",
    """SELECT day::VARCHAR AS day FROM (
         SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS day
         FROM (SELECT min(day) AS lo, max(day) AS hi FROM m_gmv))
       WHERE day NOT IN (SELECT day FROM m_gmv)""",
)
def _(w: Work) -> DataFrame:
    return reports.missing_sales_days(marts.daily_gmv_merge(marts.daily_gmv(w.orders_fact)))


@query(
    "p1_order_total_check",
    """SELECT outcome, count(*) AS orders, sum(gap)::DOUBLE AS total_gap FROM (
         SELECT CASE WHEN gross IS NULL THEN 'no_items'
                     WHEN abs(total_amount - (gross - discount_amount)) <= 0.01 THEN 'match' ELSE 'mismatch' END AS outcome,
                abs(total_amount - (coalesce(gross, 0) - discount_amount))::DECIMAL(20,2) AS gap
         FROM c_orders LEFT JOIN (SELECT order_id, sum((quantity * unit_price)::DECIMAL(18,2)) AS gross
                                  FROM c_order_items GROUP BY 1) USING (order_id)) GROUP BY 1""",
)
def _(w: Work) -> DataFrame:
    return reports.order_total_check(w.orders, w.order_items)


@query(
    "p2_payment_status_check",
    """SELECT o.status, p.status AS payment_status,
              coalesce((o.status = 'completed' AND p.status = 'succeeded') OR (o.status = 'returned' AND p.status = 'refunded')
                OR (o.status = 'cancelled' AND (p.status IS NULL OR p.status = 'failed')), false) AS consistent,
              count(*) AS orders
       FROM c_orders o LEFT JOIN c_payments p ON o.order_id = p.order_id GROUP BY 1, 2, 3""",
)
def _(w: Work) -> DataFrame:
    return reports.payment_status_check(w.orders, w.payments)


@query(
    "p3_orders_per_buyer",
    """SELECT quantile_cont(n, 0.5) AS median, quantile_cont(n, 0.99) AS p99, max(n)::BIGINT AS max_value
       FROM (SELECT user_id, count(*) AS n FROM c_orders GROUP BY 1)""",
)
def _(w: Work) -> DataFrame:
    return reports.orders_per_buyer(w.orders)


@query(
    "p4_orders_per_month",
    "SELECT date_trunc('month', created_at)::DATE::VARCHAR AS month, count(*) AS orders FROM c_orders GROUP BY 1",
)
def _(w: Work) -> DataFrame:
    return reports.orders_per_month(w.orders)


@query(
    "p5_median_price",
    "SELECT quantile_cont(price::DOUBLE, 0.5) AS median_price, max(price)::DOUBLE AS max_value FROM c_products",
)
def _(w: Work) -> DataFrame:
    return reports.median_price(w.products)


@query("p6_event_totals", "SELECT event_type, count(*) AS events FROM f_events GROUP BY 1")
def _(w: Work) -> DataFrame:
    return reports.event_totals(w.events_fact)


@query(
    "p6_completed_gmv_by_day",
    """SELECT created_at::DATE::VARCHAR AS day, sum(total_amount)::DOUBLE AS gmv
       FROM c_orders WHERE status = 'completed' GROUP BY 1""",
)
def _(w: Work) -> DataFrame:
    return reports.completed_gmv_by_day(w.orders)


@query(
    "p7_quarantine_completeness",
    """SELECT *, found >= expected AS complete FROM (
         SELECT 'orders' AS source_table, 'null_user_id' AS reason,
                (SELECT count(*) FROM s_orders WHERE user_id IS NULL) AS expected,
                (SELECT count(*) FROM q_orders WHERE reason = 'null_user_id') AS found
         UNION ALL
         SELECT 'orders', 'orphan_user', (SELECT count(*) FROM s_orders WHERE starts_with(user_id, 'ghost-')),
                (SELECT count(*) FROM q_orders WHERE reason = 'orphan_user')
         UNION ALL
         SELECT 'orders', 'duplicate_pk', (SELECT coalesce(sum(n - 1), 0)::BIGINT FROM (
                  SELECT count(*) AS n FROM j_orders WHERE base_reason IS NULL GROUP BY order_id, _source_date)),
                (SELECT count(*) FROM q_orders WHERE reason = 'duplicate_pk')
         UNION ALL
         SELECT 'order_items', 'null_product_id', (SELECT count(*) FROM s_order_items WHERE product_id IS NULL),
                (SELECT count(*) FROM j_items WHERE reason = 'null_product_id')
         UNION ALL
         SELECT 'order_items', 'orphan_product', (SELECT count(*) FROM s_order_items WHERE starts_with(product_id, 'ghost-')),
                (SELECT count(*) FROM j_items WHERE reason = 'orphan_product')
         UNION ALL
         SELECT 'order_items', 'negative_quantity', (SELECT count(*) FROM s_order_items JOIN d_products USING (product_id)
                  WHERE quantity::INT <= 0 AND first_ds <= _source_date),
                (SELECT count(*) FROM j_items WHERE reason = 'negative_quantity')
         UNION ALL
         SELECT 'order_items', 'orphan_order', (SELECT count(*) FROM s_order_items s JOIN d_products d USING (product_id)
                  WHERE quantity::INT > 0 AND first_ds <= _source_date AND order_id NOT IN (SELECT order_id FROM p_orders)),
                (SELECT count(*) FROM j_items WHERE reason = 'orphan_order')
         UNION ALL
         SELECT 'payments', 'orphan_order', (SELECT count(*) FROM s_payments WHERE order_id NOT IN (SELECT order_id FROM p_orders)),
                (SELECT count(*) FROM j_payments WHERE reason = 'orphan_order'))""",
)
def _(w: Work) -> DataFrame:
    """All eight pairs of table and reason against defects counted on the landing rows themselves."""
    known_users = lookup_key(w.staged("orders"), "user_id", w.user_keys, "user_id", "ok", "_source_date")
    copied = known_users.where("user_id IS NOT NULL AND ok").groupBy("order_id", "_source_date").agg(F.count("*").alias("n"))
    items = lookup_key(w.staged("order_items"), "product_id", w.product_keys, "product_id", "ok", "_source_date")
    stocked = items.where("product_id IS NOT NULL AND ok")
    accepted = w.verdicts["orders"].where(F.col("copy_state") == copies.FIRST).select(F.col("id").alias("order_id"))
    injected = {
        ("orders", "null_user_id"): w.staged("orders").where("user_id IS NULL"),
        ("orders", "orphan_user"): w.staged("orders").where("user_id LIKE 'ghost-%'"),
        ("orders", "duplicate_pk"): copied.select(F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k")).where("k > 1"),
        ("order_items", "null_product_id"): w.staged("order_items").where("product_id IS NULL"),
        ("order_items", "orphan_product"): w.staged("order_items").where("product_id LIKE 'ghost-%'"),
        ("order_items", "negative_quantity"): stocked.where("CAST(quantity AS INT) <= 0"),
        ("order_items", "orphan_order"): stocked.where("CAST(quantity AS INT) > 0").join(accepted, "order_id", "left_anti"),
        ("payments", "orphan_order"): w.staged("payments").join(accepted, "order_id", "left_anti"),
    }
    expected = quality.union_all(
        [
            rows.agg(F.count("*").alias("expected")).select(
                F.lit(t).alias("source_table"), F.lit(r).alias("reason"), "expected"
            )
            for (t, r), rows in injected.items()
        ]
    )
    return reports.quarantine_completeness(w.rejects, expected)


# ---- marts ----------------------------------------------------------------------


@query("m1_daily_gmv", "SELECT day::VARCHAR AS day, gmv::DOUBLE AS gmv, orders, buyers FROM m_gmv")
def _(w: Work) -> DataFrame:
    return marts.daily_gmv_exact(w.orders_fact)


@query(
    "m2_category_revenue_daily",
    """SELECT day::VARCHAR AS day, category_id::BIGINT AS category_id, category_name,
              revenue::DOUBLE AS revenue, items_sold::BIGINT AS items_sold FROM m_category""",
)
def _(w: Work) -> DataFrame:
    return marts.category_revenue_daily(w.items_fact)


@query("m3_funnel_daily", "SELECT day::VARCHAR AS day, views, carts, purchases FROM m_funnel")
def _(w: Work) -> DataFrame:
    return marts.funnel_daily(w.events_fact)


@query(
    "m4_first_buy",
    """SELECT user_id, category_id::BIGINT AS category_id, min(order_created_at)::VARCHAR AS first_buy
       FROM f_items GROUP BY 1, 2""",
)
def _(w: Work) -> DataFrame:
    return marts.first_buy_merge(marts.user_category_first_buy(w.items_fact))


@query(
    "agg1_sum_state_by_status",
    "SELECT day::VARCHAR AS day, gmv::DOUBLE AS gmv, orders FROM m_gmv",
)
def _(w: Work) -> DataFrame:
    # One partial state per payment method, as separate inserts would leave them.
    parts = (
        marts.completed(w.orders_fact)
        .groupBy(F.to_date("created_at").alias("day"), "payment_method")
        .agg(
            F.sum("total_amount").alias("gmv_state"),
            F.count("*").alias("orders_state"),
            S.uniq_state("user_id").alias("buyers_state"),
        )
    )
    return marts.daily_gmv_merge(marts.daily_gmv_collapse(parts.drop("payment_method"))).drop("buyers")


@query(
    "agg5_summing_collapse",
    """SELECT day::VARCHAR AS day, category_id::BIGINT AS category_id, category_name,
              revenue::DOUBLE AS revenue, items_sold::BIGINT AS items_sold FROM m_category""",
)
def _(w: Work) -> DataFrame:
    parts = w.items_fact.groupBy(
        F.to_date("order_created_at").alias("day"), "category_id", "category_name", "quantity"
    ).agg(F.sum("line_revenue").alias("revenue"), F.sum("quantity").alias("items_sold"))
    return marts.category_revenue_merge(parts)


@query(
    "agg7_latest_dim_version",
    """SELECT user_id, CASE WHEN user_id::BIGINT % 5 = 0 THEN 'new-' || email ELSE email END AS email,
              CASE WHEN user_id::BIGINT % 5 = 0 THEN 'Elsewhere' ELSE city END AS city FROM c_users""",
)
def _(w: Work) -> DataFrame:
    versions = w.staged("users").withColumn("updated_at", F.col("_loaded_at"))
    return copies.latest_version(versions, ["user_id"], "updated_at").select("user_id", "email", "city")


@query(
    "agg14_session_levels",
    "SELECT session_id, level::BIGINT AS level FROM w_session_levels",
)
def _(w: Work) -> DataFrame:
    steps = [F.col("event_type") == s for s in reports.FUNNEL_STEPS]
    return funnel.window_funnel(w.events_fact, ["session_id"], "created_at", steps, 86400)


@query(
    "agg14_user_levels_two_hours",
    "SELECT user_id, level::BIGINT AS level FROM w_user_levels",
)
def _(w: Work) -> DataFrame:
    steps = [F.col("event_type") == s for s in reports.FUNNEL_STEPS]
    return funnel.window_funnel(w.events_fact, ["user_id"], "created_at", steps, 7200)


# ---- states that merge ------------------------------------------------------------


def in_parts(rows: DataFrame, n: int = 3) -> list[DataFrame]:
    """The rows dealt out into parts that overlap in time."""
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(n))
    return [rows.where(part == k) for k in range(n)]


@query("agg14_session_levels_from_parts", "SELECT session_id, level::BIGINT AS level FROM w_session_levels")
def _(w: Work) -> DataFrame:
    """Levels merged from the cells of three cuts of the events, one of them given twice."""
    parts = in_parts(w.events_fact)
    return marts.session_levels_merge(quality.union_all([marts.session_funnel_cells(p) for p in (*parts, parts[0])]))


@query("agg14_user_levels_from_summaries", "SELECT user_id, level::BIGINT AS level FROM w_user_levels")
def _(w: Work) -> DataFrame:
    """Chains over midnight, from one fixed-size summary per user and day."""
    steps = [F.col("event_type") == s for s in reports.FUNNEL_STEPS]
    parts = quality.union_all([funnel_state.cells(p, ["user_id"], "created_at", steps) for p in in_parts(w.events_fact)])
    days = w.keep("summaries", funnel_state.summaries(parts, ["user_id"], 3, 7200))
    return funnel_state.combine(days, ["user_id"], 3, 7200).select("user_id", funnel_state.level(3).alias("level"))


def _bitmaps(w: Work) -> DataFrame:
    """The mart of three cuts of the orders, whose buyers were numbered in three steps."""
    parts, known = in_parts(w.orders_fact), None
    for part in parts:
        fresh = numbering.numbered(part, "user_id", known)
        known = w.keep("numbers", fresh if known is None else known.unionByName(fresh))
    return w.keep("buyers", quality.union_all([marts.daily_buyers(p, known) for p in parts]))


@query(
    "agg11_buyers_by_day_and_month",
    """SELECT 'day' AS span, day::VARCHAR AS first_day, buyers FROM m_gmv
       UNION ALL SELECT 'month', date_trunc('month', created_at)::DATE::VARCHAR, count(DISTINCT user_id)
       FROM f_orders WHERE status = 'completed' GROUP BY 2""",
)
def _(w: Work) -> DataFrame:
    """Exact buyers of every day and month from the same bitmaps."""
    mart = _bitmaps(w)
    days = states.bitmap_distinct(mart, "day", out="buyers")
    months = states.bitmap_distinct(mart.withColumn("day", D.month_start("day")), "day", out="buyers")
    labelled = [r.select(F.lit(s).alias("span"), F.col("day").alias("first_day"), "buyers") for s, r in (("day", days), ("month", months))]
    return quality.union_all(labelled)


@query(
    "m1_buyers_of_spans",
    """SELECT '1996-02-29' AS first_day, count(DISTINCT user_id) AS buyers FROM f_orders
       WHERE status = 'completed' AND created_at::DATE BETWEEN DATE '1996-02-29' AND DATE '1996-03-11'
       UNION ALL SELECT '1992-01-01', count(DISTINCT user_id) FROM f_orders WHERE status = 'completed'""",
)
def _(w: Work) -> DataFrame:
    mart = _bitmaps(w)
    spans = [("1996-02-29", "1996-03-11"), ("1992-01-01", "2099-12-31")]
    return quality.union_all([marts.buyers_of_span(mart, a, b).select(F.lit(a).alias("first_day"), "buyers") for a, b in spans])


@query(
    "q3_retention_from_sketches",
    """SELECT cohort::VARCHAR AS cohort, month_offset::BIGINT AS month_offset, users, true AS within_bound FROM x_retention""",
)
def _(w: Work) -> DataFrame:
    """Retention from monthly theta sketches of three cuts of the orders, next to the exact one."""
    groups = w.users_dim.select("user_id", D.month_start("registration_date").alias("cohort"))
    sketches = quality.union_all([marts.monthly_buyers(p) for p in in_parts(w.orders_fact)])
    near = reports.retention_from_sketches(marts.cohort_members(groups), sketches).withColumnRenamed("users", "estimate")
    exact = reports.cohort_retention(groups, w.orders_fact)
    gap = F.abs(F.col("estimate") - F.col("users"))
    bound = states.theta_bound(F.col("users"), F.col("larger"))
    return exact.join(near, ["cohort", "month_offset"]).select("cohort", "month_offset", "users", (gap <= bound).alias("within_bound"))


@query(
    "p5_order_value_quantiles",
    """SELECT count(total_amount) AS orders, true AS median_near, true AS p99_near FROM f_orders WHERE status = 'completed'""",
)
def _(w: Work) -> DataFrame:
    """Median and 99th percentile from daily KLL sketches of three cuts: their true ranks lie within the sketch's error."""
    sketches = quality.union_all([marts.daily_order_values(p) for p in in_parts(w.orders_fact)])
    found = marts.order_value_quantiles(sketches, {"median": 0.5, "p99": 0.99}).first()
    error = 2 * states.kll_rank_error()  # twice, for the merges and the many points of all data
    paid = w.orders_fact.where("status = 'completed'").agg(
        F.count("total_amount").alias("orders"),
        *[
            (F.count_if(F.col("total_amount").cast("double") <= found[name]) / F.count("total_amount")).alias(name)
            for name in ("median", "p99")
        ],
    )
    near = [(F.abs(F.col(name) - point) <= error).alias(f"{name}_near") for name, point in (("median", 0.5), ("p99", 0.99))]
    return paid.select("orders", *near)


@query(
    "srt2_top_products",
    """SELECT product_id, sum(line_revenue)::DOUBLE AS revenue FROM f_items GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def _(w: Work) -> DataFrame:
    """Exact top products after bounded daily summaries have ruled out the others."""
    # Both passes read the joined items, of which they need three columns.
    sold = w.keep("sold", w.items_fact.select("order_created_at", "product_id", "line_revenue"))
    summaries = w.keep("heavy", marts.product_revenue_summaries(sold))
    return reports.top_products(sold, 10, summaries)


# ---- denormalised facts -----------------------------------------------------------


@query(
    "pl12_users_dim",
    """SELECT user_id, email, full_name, registration_date::VARCHAR AS registration_date, acquisition_channel,
              city, age_group, is_active::BIGINT AS is_active FROM f_users_dim""",
)
def _(w: Work) -> DataFrame:
    return w.users_dim


@query(
    "pl13_products_dim",
    """SELECT product_id, name, category_id::BIGINT AS category_id, category_name, parent_category,
              price::DOUBLE AS price, cost_price::DOUBLE AS cost_price, rating::DOUBLE AS rating,
              is_available::BIGINT AS is_available FROM f_products_dim""",
)
def _(w: Work) -> DataFrame:
    return w.products_dim


@query(
    "pl14_orders_fact",
    """SELECT order_id, user_id, created_at::VARCHAR AS created_at, status, payment_method,
              total_amount::DOUBLE AS total_amount, discount_amount::DOUBLE AS discount_amount,
              items_count::BIGINT AS items_count, acquisition_channel, user_city, user_age_group FROM f_orders""",
)
def _(w: Work) -> DataFrame:
    return w.orders_fact


@query(
    "jn5_orders_fact_join_then_group",
    """SELECT order_id, user_id, created_at::VARCHAR AS created_at, status, payment_method,
              total_amount::DOUBLE AS total_amount, discount_amount::DOUBLE AS discount_amount,
              items_count::BIGINT AS items_count, acquisition_channel, user_city, user_age_group FROM f_orders""",
)
def _(w: Work) -> DataFrame:
    return facts.orders_fact_join_then_group(w.orders, w.users, w.order_items)


@query(
    "pl15_order_items_fact",
    """SELECT order_item_id, order_id, order_created_at::VARCHAR AS order_created_at, user_id, product_id,
              category_id::BIGINT AS category_id, category_name, quantity::BIGINT AS quantity,
              unit_price::DOUBLE AS unit_price, line_revenue::DOUBLE AS line_revenue FROM f_items""",
)
def _(w: Work) -> DataFrame:
    return w.items_fact


@query(
    "pl16_payments_fact",
    """SELECT payment_id, order_id, amount::DOUBLE AS amount, method, status,
              processed_at::VARCHAR AS processed_at FROM c_payments""",
)
def _(w: Work) -> DataFrame:
    return facts.payments_fact(w.payments)


@query(
    "pl17_events_fact",
    "SELECT user_id, session_id, product_id, event_type, created_at::VARCHAR AS created_at FROM f_events",
)
def _(w: Work) -> DataFrame:
    return w.events_fact


# ---- joins and scalar functions -----------------------------------------------------


@query(
    "jn6_orders_of_known_users",
    """SELECT order_id, user_id, _source_date::VARCHAR AS source_date FROM s_orders s
       WHERE EXISTS (SELECT 1 FROM d_users u WHERE u.user_id = s.user_id)""",
)
def _(w: Work) -> DataFrame:
    rows = w.staged("orders").select("order_id", "user_id", F.col("_source_date").alias("source_date"))
    return rows.join(w.user_keys.select("user_id"), "user_id", "left_semi")  # keys have an exchange of their own


@query(
    "jn7_orders_of_unknown_users",
    """SELECT order_id, user_id, _source_date::VARCHAR AS source_date FROM s_orders s
       WHERE user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM d_users u WHERE u.user_id = s.user_id)""",
)
def _(w: Work) -> DataFrame:
    rows = w.staged("orders").where("user_id IS NOT NULL")
    rows = rows.select("order_id", "user_id", F.col("_source_date").alias("source_date"))
    return rows.join(w.user_keys.select("user_id"), "user_id", "left_anti")


@query(
    "jn8_item_lookup_outcomes",
    """SELECT p.product_id IS NOT NULL AS has_product, s.product_id IS NULL AS missing, count(*) AS rows
       FROM s_order_items s LEFT JOIN d_products p ON s.product_id = p.product_id GROUP BY 1, 2""",
)
def _(w: Work) -> DataFrame:
    rows = lookup_key(
        w.staged("order_items"), "product_id", w.product_keys, "product_id", "has_product", None
    )
    keys = ["has_product", F.col("product_id").isNull().alias("missing")]
    return rows.groupBy(*keys).agg(F.count("*").alias("rows"))


@query(
    "jn9_orphan_counts",
    """SELECT (SELECT count(*) FROM s_order_items WHERE order_id NOT IN (SELECT order_id FROM p_orders)) AS orphan_order_items,
              (SELECT count(*) FROM s_order_items WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM d_products)) AS orphan_product_items,
              (SELECT count(*) FROM s_order_items WHERE quantity::INT <= 0) AS nonpositive_qty,
              (SELECT count(*) FROM s_orders WHERE user_id IS NULL) AS null_user_orders""",
)
def _(w: Work) -> DataFrame:
    """The four gate counts on landing rows, where they are not zero."""
    items = w.staged("order_items").withColumn("quantity", F.col("quantity").cast("int"))
    checked = quality.integrity_counts(w.order_promotion.accepted, items, w.product_keys)
    missing = w.staged("orders").agg(F.count_if(F.col("user_id").isNull()).alias("n"))
    lines = checked.drop("null_user_orders").withColumn("n", F.lit(None).cast("bigint")).unionByName(
        missing.withColumns({c: F.lit(None).cast("bigint") for c in checked.columns[:3]})
    )
    return lines.agg(
        *[F.max(c).alias(c) for c in checked.columns[:3]], F.max("n").alias("null_user_orders")
    )


@query("jn10_pairs_by_self_join", "SELECT cat_a, cat_b, together::BIGINT AS together FROM b_pairs")
def _(w: Work) -> DataFrame:
    return basket.category_pairs_by_join(w.items_by_order, "order_id", "category_name")


@query("s2_all_category_pairs", "SELECT cat_a, cat_b, together::BIGINT AS together FROM b_pairs")
def _(w: Work) -> DataFrame:
    return basket.category_pairs(w.items_by_order, "order_id", "category_name")


@query(
    "jn12_category_dictionary",
    """SELECT p.product_id, c.name AS category_name FROM c_products p
       LEFT JOIN c_categories c ON p.category_id = c.category_id""",
)
def _(w: Work) -> DataFrame:
    return facts.category_lookup(w.products, w.categories).select("product_id", "category_name")


@query(
    "jn3_category_tree",
    """SELECT c.category_id::BIGINT AS category_id, c.name, p.name AS parent_name
       FROM c_categories c LEFT JOIN c_categories p ON c.parent_id = p.category_id""",
)
def _(w: Work) -> DataFrame:
    return facts.with_parent_names(w.categories).select("category_id", "name", "parent_name")


@query(
    "jn13_asof_effect",
    """SELECT 'arrival_order' AS rule, count(*) FILTER (reason IS NULL) AS clean_rows, count(*) FILTER (reason IS NOT NULL) AS rejected_rows FROM j_items
       UNION ALL
       SELECT 'one_load', count(*) FILTER (reason IS NULL), count(*) FILTER (reason IS NOT NULL) FROM jo_items""",
)
def _(w: Work) -> DataFrame:
    """How many items the arrival rule decides differently from one big load."""
    once = _one_load_items(w)
    labelled = [
        rows.select(F.lit(rule).alias("rule"), "reject_reason")
        for rule, rows in {"arrival_order": w.judged_items, "one_load": once}.items()
    ]
    return (
        quality.union_all(labelled)
        .groupBy("rule")
        .agg(
            F.count_if(F.col("reject_reason").isNull()).alias("clean_rows"),
            F.count_if(F.col("reject_reason").isNotNull()).alias("rejected_rows"),
        )
    )


@query(
    "fn_calendar",
    """SELECT order_id, created_at::DATE::VARCHAR AS day, date_trunc('month', created_at)::DATE::VARCHAR AS month,
              (year(created_at) * 100 + month(created_at))::BIGINT AS yyyymm,
              date_diff('month', DATE '1995-01-01', date_trunc('month', created_at)::DATE)::BIGINT AS months,
              epoch(created_at)::BIGINT AS seconds FROM c_orders""",
)
def _(w: Work) -> DataFrame:
    first = F.lit("1995-01-01").cast("date")
    return w.orders.select(
        "order_id",
        D.day("created_at").alias("day"),
        D.month_start("created_at").alias("month"),
        D.yyyymm("created_at").alias("yyyymm"),
        D.months_between_starts(first, D.month_start("created_at")).alias("months"),
        D.epoch_seconds("created_at").alias("seconds"),
    )


@query(
    "fn_uuid_text",
    "SELECT order_id, md5(order_id)::UUID::VARCHAR AS id FROM c_orders",
)
def _(w: Work) -> DataFrame:
    braces = F.concat(F.lit("{"), F.upper(F.md5("order_id")), F.lit("}"))
    return w.orders.select("order_id", C.canonical_uuid(braces).alias("id"))


@query(
    "prj1_typed_orders",
    """SELECT order_id, user_id, created_at::TIMESTAMP::VARCHAR AS created_at, total_amount::DOUBLE AS total_amount,
              coalesce(nullif(discount_amount, ''), '0')::DECIMAL(12,2)::DOUBLE AS discount_amount,
              nullif(promo_code, '') AS promo_code, _source_date::VARCHAR AS source_date FROM s_orders""",
)
def _(w: Work) -> DataFrame:
    typed = promote.type_orders(w.staged("orders"), uuid_ids=False)
    return typed.select(
        "order_id", "user_id", "created_at", "total_amount", "discount_amount", "promo_code",
        F.col("_source_date").alias("source_date"),
    )


@query(
    "flt3_sales_of_one_day",
    "SELECT order_id, created_at::VARCHAR AS created_at FROM f_orders WHERE created_at::DATE = DATE '1997-06-15'",
)
def _(w: Work) -> DataFrame:
    day = facts.orders_fact(w.orders, w.users, w.order_items, days=["1997-06-15"])
    return day.select("order_id", "created_at")


# ---- promotion ------------------------------------------------------------------------


@query(
    "pl1_core_categories",
    """SELECT category_id::BIGINT AS category_id, name, parent_id::BIGINT AS parent_id FROM c_categories""",
)
def _(w: Work) -> DataFrame:
    return w.core_categories.select("category_id", "name", "parent_id")


@query(
    "pl1_core_users",
    """SELECT user_id, email, full_name, registration_date::VARCHAR AS registration_date, acquisition_channel, city,
              age_group, is_active, first_ds::VARCHAR AS first_ds FROM d_users""",
)
def _(w: Work) -> DataFrame:
    return w.core_users


@query(
    "pl1_core_products",
    """SELECT product_id, name, category_id::BIGINT AS category_id, price::DOUBLE AS price,
              cost_price::DOUBLE AS cost_price, rating::DOUBLE AS rating, is_available,
              created_at::VARCHAR AS created_at, first_ds::VARCHAR AS first_ds FROM d_products""",
)
def _(w: Work) -> DataFrame:
    return w.core_products


@query(
    "pl2_orders_promoted",
    """SELECT order_id, user_id, created_at::VARCHAR AS created_at, status, payment_method,
              total_amount::DOUBLE AS total_amount, discount_amount::DOUBLE AS discount_amount, promo_code,
              _source_date::VARCHAR AS _source_date FROM p_orders""",
)
def _(w: Work) -> DataFrame:
    return w.order_promotion.accepted


@query(
    "pl2_orders_rejected",
    "SELECT order_id, user_id, created_at, reason, _source_date::VARCHAR AS _source_date FROM q_orders",
)
def _(w: Work) -> DataFrame:
    return w.order_promotion.rejected.select(
        "order_id", "user_id", "created_at", F.col("reject_reason").alias("reason"), "_source_date"
    )


@query(
    "pl3_items_promoted",
    """SELECT order_item_id, order_id, product_id, quantity::BIGINT AS quantity, unit_price::DOUBLE AS unit_price,
              _source_date::VARCHAR AS _source_date FROM p_items""",
)
def _(w: Work) -> DataFrame:
    return w.item_promotion.accepted


@query(
    "pl3_items_rejected",
    """SELECT order_item_id, order_id, product_id, quantity, reason, _source_date::VARCHAR AS _source_date
       FROM j_items WHERE reason IS NOT NULL""",
)
def _(w: Work) -> DataFrame:
    return w.item_promotion.rejected.select(
        "order_item_id", "order_id", "product_id", "quantity",
        F.col("reject_reason").alias("reason"), "_source_date",
    )


@query(
    "pl4_payments_promoted",
    """SELECT payment_id, order_id, amount::DOUBLE AS amount, method, status, processed_at::VARCHAR AS processed_at,
              _source_date::VARCHAR AS _source_date FROM p_payments""",
)
def _(w: Work) -> DataFrame:
    return w.payment_promotion.accepted


@query(
    "pl5_cascade_by_order_reason",
    """SELECT p.source_table, coalesce(o.reason, 'order_not_rejected') AS order_reason, count(*) AS rows_rejected
       FROM (SELECT 'order_items' AS source_table, order_id FROM j_items WHERE reason = 'orphan_order'
             UNION ALL SELECT 'payments', order_id FROM j_payments WHERE reason = 'orphan_order') p
       LEFT JOIN (SELECT DISTINCT order_id, reason FROM q_orders) o ON p.order_id = o.order_id GROUP BY 1, 2""",
)
def _(w: Work) -> DataFrame:
    """Items and payments rejected with their order, by what happened to the order."""
    reasons = w.order_promotion.rejected.select("order_id", F.col("reject_reason").alias("order_reason")).distinct()
    lost = [
        p.rejected.where(F.col("reject_reason") == promote.ORPHAN_ORDER).select(F.lit(t).alias("source_table"), "order_id")
        for t, p in (("order_items", w.item_promotion), ("payments", w.payment_promotion))
    ]
    return (
        quality.union_all(lost)
        .join(reasons, "order_id", "left")
        .groupBy("source_table", F.coalesce("order_reason", F.lit("order_not_rejected")).alias("order_reason"))
        .agg(F.count("*").alias("rows_rejected"))
    )


@query(
    "pl6_quarantine_rows",
    """SELECT 'orders' AS source_table, _source_date::VARCHAR AS source_date, reason,
              json_object('order_id', order_id, 'user_id', user_id, 'created_at', created_at, 'status', status,
                'payment_method', payment_method, 'total_amount', total_amount, 'discount_amount', discount_amount,
                'promo_code', promo_code, '_source_date', _source_date::VARCHAR,
                '_loaded_at', strftime(_source_date, '%Y-%m-%dT00:00:00.000'), '_batch_id', 'batch-1')::VARCHAR AS raw_data
       FROM q_orders
       UNION ALL
       SELECT 'order_items', _source_date::VARCHAR, reason,
              json_object('order_item_id', order_item_id, 'order_id', order_id, 'product_id', product_id,
                'quantity', quantity, 'unit_price', unit_price, '_source_date', _source_date::VARCHAR,
                '_loaded_at', strftime(_source_date, '%Y-%m-%dT00:00:00.000'), '_batch_id', 'batch-1')::VARCHAR
       FROM j_items WHERE reason IS NOT NULL
       UNION ALL
       SELECT 'payments', _source_date::VARCHAR, reason,
              json_object('payment_id', payment_id, 'order_id', order_id, 'amount', amount, 'method', method,
                'status', status, 'processed_at', processed_at, '_source_date', _source_date::VARCHAR,
                '_loaded_at', strftime(_source_date, '%Y-%m-%dT00:00:00.000'), '_batch_id', 'batch-1')::VARCHAR
       FROM j_payments WHERE reason IS NOT NULL""",
)
def _(w: Work) -> DataFrame:
    w.keep_judged()
    return w.rejected.drop("rejected_at")


@query(
    "pl7_uncategorised_products",
    "SELECT count(*) AS products, count_if(category_id IS NULL) AS uncategorised FROM d_products",
)
def _(w: Work) -> DataFrame:
    return w.core_products.agg(
        F.count("*").alias("products"),
        F.count_if(F.col("category_id").isNull()).alias("uncategorised"),
    )


AUDIT_SQL = """SELECT source_date::VARCHAR AS source_date, source_table, rows_staging, rows_promoted, rows_rejected,
                      rows_conflict_skipped, rows_manifest FROM n_audit LEFT JOIN n_announced USING (source_date, source_table)"""


@query("pl8_load_audit", AUDIT_SQL)
def _(w: Work) -> DataFrame:
    return w.audit


@query(
    "pl9_integrity_gate",
    """SELECT (SELECT count(*) FROM p_items WHERE order_id NOT IN (SELECT order_id FROM p_orders)) AS orphan_order_items,
              (SELECT count(*) FROM p_items WHERE product_id NOT IN (SELECT product_id FROM d_products)) AS orphan_product_items,
              (SELECT count(*) FROM p_items WHERE quantity <= 0) AS nonpositive_qty,
              (SELECT count(*) FROM p_orders WHERE user_id IS NULL) AS null_user_orders""",
)
def _(w: Work) -> DataFrame:
    w.keep_judged("orders", "items")
    return quality.integrity_counts(w.order_promotion.accepted, w.item_promotion.accepted, w.core_products)


@query(
    "pl10_manifest_shortfalls",
    """SELECT source_date::VARCHAR AS source_date, source_table, coalesce(rows_staging, 0) AS rows_staging, rows_manifest
       FROM (SELECT source_date, source_table, 2 + rows_manifest AS rows_manifest FROM n_announced) m
       LEFT JOIN n_staged s USING (source_date, source_table) WHERE coalesce(rows_staging, 0) < rows_manifest""",
)
def _(w: Work) -> DataFrame:
    """Landing counts against manifests that announce two more rows of each fact than were placed."""
    staged = landing.landed_counts({t: w.staged(t) for t in ("orders", "order_items", "payments")})
    return quality.shortfalls(staged, w.announced.withColumn("rows_manifest", F.col("rows_manifest") + 2))


@query(
    "pl11_whole_table_audit",
    """SELECT 'orders' AS source_table, (SELECT count(*) FROM s_orders) AS rows_staging,
              (SELECT count(*) FROM p_orders) AS rows_promoted, (SELECT count(*) FROM q_orders) AS rows_rejected
       UNION ALL SELECT 'order_items', (SELECT count(*) FROM s_order_items), (SELECT count(*) FROM p_items),
              (SELECT count(*) FROM j_items WHERE reason IS NOT NULL)""",
)
def _(w: Work) -> DataFrame:
    parts = []
    for table in ("orders", "order_items"):
        counted = {
            "rows_staging": w.verdicts[table],
            "rows_promoted": w.winners(table),
            "rows_rejected": w.verdicts[table].where("reject_reason IS NOT NULL"),
        }
        parts += [f.select(F.lit(table).alias("source_table"), F.lit(n).alias("kind")) for n, f in counted.items()]
    kinds = ["rows_staging", "rows_promoted", "rows_rejected"]
    return (
        quality.union_all(parts)
        .groupBy("source_table")
        .agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds])
    )


def _one_load_items(w: Work) -> DataFrame:
    judged = promote.classify_orders(w.staged("orders"), w.user_keys, as_of=False)
    orders = promote.split_orders(judged, uuid_ids=False).accepted
    return promote.classify_items(
        w.staged("order_items"), w.product_keys, promote.arrived_orders(orders), as_of=False
    )


@query(
    "pl19_one_load_item_reasons",
    "SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS rows FROM jo_items GROUP BY 1",
)
def _(w: Work) -> DataFrame:
    outcome = F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")
    return _one_load_items(w).groupBy(outcome).agg(F.count("*").alias("rows"))


@query(
    "pl20_plain_users",
    """SELECT user_id, email, full_name, registration_date::VARCHAR AS registration_date, acquisition_channel, city,
              age_group, is_active::BOOLEAN AS is_active FROM s_users""",
)
def _(w: Work) -> DataFrame:
    return promote.plain_dimension(promote.type_users(w.staged("users"), uuid_ids=False))


@query(
    "pl20_plain_categories",
    """SELECT category_id::DECIMAL(38,6)::BIGINT AS category_id, name,
              nullif(parent_id, '')::DECIMAL(38,6)::BIGINT AS parent_id FROM s_categories""",
)
def _(w: Work) -> DataFrame:
    return promote.plain_dimension(promote.type_categories(w.staged("categories")))


@query(
    "pl20_plain_products",
    """SELECT product_id, name, nullif(category_id, '')::DECIMAL(38,6)::BIGINT AS category_id, price::DOUBLE AS price,
              cost_price::DOUBLE AS cost_price, rating::DOUBLE AS rating, is_available::BOOLEAN AS is_available,
              created_at::TIMESTAMP::VARCHAR AS created_at FROM s_products""",
)
def _(w: Work) -> DataFrame:
    return promote.plain_dimension(promote.type_products(w.staged("products"), uuid_ids=False))


@query(
    "win1_order_copies",
    """SELECT order_id, created_at, _source_date::VARCHAR AS source_date,
              CASE WHEN rn_all = 1 THEN 'first' WHEN rn_day > 1 THEN 'same_run' ELSE 'later_run' END AS copy_state
       FROM r_orders""",
)
def _(w: Work) -> DataFrame:
    judged = promote.classify_orders(w.staged("orders"), w.user_keys)
    return judged.where("copy_state IS NOT NULL").select(
        "order_id", "created_at", F.col("_source_date").alias("source_date"), "copy_state"
    )


@query(
    "ups1_insert_if_absent",
    """SELECT order_item_id, order_id, product_id, quantity::BIGINT AS quantity, unit_price::DOUBLE AS unit_price
       FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY order_id, product_id, quantity, unit_price) AS rn
             FROM c_order_items) WHERE rn = 1 AND order_id NOT IN (SELECT order_id FROM c_orders WHERE status = 'returned')""",
)
def _(w: Work) -> DataFrame:
    """Items to add when those of returned orders are already stored."""
    returned = w.orders.where("status = 'returned'").select("order_id")
    stored = w.order_items.join(returned, "order_id", "left_semi")
    return upsert.insert_if_absent(w.order_items, stored, "order_item_id", ["order_item_id"])


@query(
    "ups4_conflict_skips",
    """SELECT source_table, sum(rows_conflict_skipped)::BIGINT AS skipped FROM n_audit GROUP BY 1""",
)
def _(w: Work) -> DataFrame:
    return w.audit.groupBy("source_table").agg(F.sum("rows_conflict_skipped").alias("skipped"))


@query(
    "agg17_rejects_by_day",
    """SELECT source_table, source_date::VARCHAR AS source_date, reason, count(*) AS rows_rejected
       FROM q_all GROUP BY 1, 2, 3""",
)
def _(w: Work) -> DataFrame:
    return w.reject_counts


def _constraints_sql(users: str, products: str, orders: str, items: str, payments: str) -> str:
    tables = {"categories": "c_categories", "users": users, "products": products, "orders": orders,
              "order_items": items, "payments": payments}
    lines = []
    for t, rule in quality.CORE_RULES.items():
        src = tables[t]
        for c in dict.fromkeys([*rule.unique[:1], *rule.not_null]):
            lines.append((t, "not_null", c, f"SELECT count(*) FROM {src} WHERE {c} IS NULL"))
        for c, text in rule.checks.items():
            lines.append((t, "check", c, f"SELECT count(*) FROM {src} WHERE NOT ({text})"))
        for c in rule.unique:
            lines.append((t, "unique", c, f"SELECT count(*) FROM (SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"))
        for c, (parent, key) in rule.foreign.items():
            lines.append((t, "foreign_key", c, f"SELECT count(*) FROM {src} x WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {tables[parent]} y WHERE y.{key} = x.{c})"))
    return " UNION ALL ".join(
        f"SELECT '{t}' AS source_table, '{r}' AS rule, '{c}' AS column_name, ({q}) AS violations" for t, r, c, q in lines
    )


@query(
    "con1_to_con5_promoted_core",
    _constraints_sql("d_users", "d_products", "p_orders", "p_items", "p_payments"),
)
def _(w: Work) -> DataFrame:
    w.keep_judged()
    return quality.constraint_report(
        {
            "categories": w.core_categories, "users": w.core_users, "products": w.core_products,
            **{t: p.accepted for t, p in w.promotions.items()},
        }
    )


@query(
    "con1_to_con5_unchecked_core",
    _constraints_sql("c_users", "c_products", "c_orders", "c_order_items", "c_payments"),
)
def _(w: Work) -> DataFrame:
    """Same checks on tables that were never promoted: repeated line ids show up."""
    names = ["categories", "users", "products", "orders", "order_items", "payments"]
    return quality.constraint_report({n: getattr(w, n) for n in names})


@query(
    "jn4_items_per_order",
    """SELECT o.order_id, coalesce(n, 0)::BIGINT AS items_count FROM c_orders o
       LEFT JOIN (SELECT order_id, count(*) AS n FROM c_order_items GROUP BY 1) i ON i.order_id = o.order_id""",
)
def _(w: Work) -> DataFrame:
    return w.orders_fact.select("order_id", "items_count")


@query(
    "con6_omitted_columns",
    """SELECT order_id, 0.0::DOUBLE AS discount_amount, NULL::VARCHAR AS promo_code FROM s_orders""",
)
def _(w: Work) -> DataFrame:
    """Orders delivered without discount and promotion columns."""
    short = w.staged("orders").drop("discount_amount", "promo_code")
    typed = promote.type_orders(promote.fill_omitted(short, "orders"), uuid_ids=False)
    return typed.select("order_id", "discount_amount", "promo_code")


@query(
    "con6_omitted_flags",
    """SELECT 'users' AS entity, user_id AS id, true AS flag FROM s_users
       UNION ALL SELECT 'products', product_id, true FROM s_products""",
)
def _(w: Work) -> DataFrame:
    """Users and products delivered without their flags, which default to true."""
    users = promote.type_users(promote.fill_omitted(w.staged("users").drop("is_active"), "users"), uuid_ids=False)
    products = promote.type_products(promote.fill_omitted(w.staged("products").drop("is_available"), "products"), uuid_ids=False)
    return users.select(F.lit("users").alias("entity"), F.col("user_id").alias("id"), F.col("is_active").alias("flag")).unionByName(
        products.select(F.lit("products").alias("entity"), F.col("product_id").alias("id"), F.col("is_available").alias("flag"))
    )


# ---- sources and sinks ------------------------------------------------------------------


# ---- attributes valid at a time ---------------------------------------------------


@query(
    "jn13_orders_then",
    """SELECT order_id, o.user_id, o.created_at::VARCHAR AS created_at, u.city AS city_now, v.city AS then_city,
              v.acquisition_channel AS then_acquisition_channel, v.age_group AS then_age_group
       FROM c_orders o JOIN d_users u ON o.user_id = u.user_id
       ASOF LEFT JOIN (SELECT user_id, city, acquisition_channel, age_group, _source_date::TIMESTAMP AS valid_from FROM s_users) v
         ON o.user_id = v.user_id AND o.created_at >= v.valid_from""",
)
def _(w: Work) -> DataFrame:
    """Every order with the city its buyer had at the time, before the first delivery none, next to today's."""
    orders = w.orders.select("order_id", "user_id", "created_at")
    now = w.core_users.select("user_id", F.col("city").alias("city_now"))
    versions = history.user_versions(promote.type_users(w.staged("users"), uuid_ids=False))
    return history.orders_then(orders.join(now, "user_id"), versions)


@query(
    "jn13_items_then",
    """SELECT order_item_id, f.product_id, quantity::BIGINT AS quantity, v.name AS then_name, v.category_id::BIGINT AS then_category_id,
              v.price::DOUBLE AS then_price, (quantity * (v.price - v.cost_price))::DECIMAL(18,2)::DOUBLE AS then_margin
       FROM f_items f
       ASOF LEFT JOIN (SELECT product_id, name, try_cast(category_id AS DOUBLE)::INT AS category_id, price::DECIMAL(12,2) AS price,
                              cost_price::DECIMAL(12,2) AS cost_price, _source_date::TIMESTAMP AS valid_from FROM s_products) v
         ON f.product_id = v.product_id AND f.order_created_at >= v.valid_from""",
)
def _(w: Work) -> DataFrame:
    """Every item with the price list of its order's time."""
    versions = history.product_versions(promote.type_products(w.staged("products"), uuid_ids=False))
    return history.items_then(w.items_fact, versions).select(
        "order_item_id", "product_id", "quantity", "then_name", "then_category_id", "then_price", "then_margin"
    )


@query(
    "snk6_version_history",
    """SELECT user_id, city, valid_from::VARCHAR AS valid_from,
              lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from)::VARCHAR AS valid_to
       FROM (SELECT user_id, city, _source_date::TIMESTAMP AS valid_from,
                    lag(struct_pack(city := city, c := acquisition_channel, a := age_group)) OVER (PARTITION BY user_id ORDER BY _source_date) AS b,
                    struct_pack(city := city, c := acquisition_channel, a := age_group) AS n FROM s_users)
       WHERE b IS NULL OR b IS DISTINCT FROM n""",
)
def _(w: Work) -> DataFrame:
    """Deliveries that changed a user, each with the time it held."""
    return history.user_versions(promote.type_users(w.staged("users"), uuid_ids=False)).select("user_id", "city", "valid_from", "valid_to")


@query(
    "src1_landing_round_trip",
    """SELECT order_id, user_id, created_at, status, payment_method, total_amount,
              nullif(discount_amount, '') AS discount_amount, nullif(promo_code, '') AS promo_code FROM s_orders""",
)
def _(w: Work) -> DataFrame:
    """All landing orders written to one CSV table in two appends and scanned back as text."""
    root = w.folder_for("monolith")
    rows, done = w.staged("orders"), F.col("status").eqNullSafe("completed")
    sinks.write_monolith(rows.where(done), root, "orders", first=True)
    sinks.write_monolith(rows.where(~done), root, "orders", first=False)
    return landing.read_monolith(w.spark, root, "orders")


@query(
    "src1_split_scan",
    """SELECT order_item_id, order_id || chr(10) || '"' || order_id || '",' AS order_id,
              product_id || chr(13) || chr(10) || chr(10) || 'x' AS product_id, quantity, '""' || unit_price AS unit_price FROM s_order_items""",
)
def _(w: Work) -> DataFrame:
    """All landing items with line breaks, quotes and commas inside their fields, cut into records split by split."""
    root = w.folder_for("awkward")
    rows = w.staged("order_items")
    breaks = {
        "order_id": F.concat("order_id", F.lit('\n"'), "order_id", F.lit('",')),
        "product_id": F.concat("product_id", F.lit("\r\n\nx")),
        "unit_price": F.concat(F.lit('""'), "unit_price"),
    }
    sinks.write_monolith(rows.withColumns(breaks), root, "order_items", first=True)
    return landing.read_csv(w.spark, "order_items", f"{root}/order_items.csv", split=True)


@query(
    "src6_split_event_scan",
    """SELECT user_id, session_id || chr(10) || '"s",' AS session_id, product_id, event_type, created_at::VARCHAR AS created_at
       FROM f_events""",
)
def _(w: Work) -> DataFrame:
    """Typed events, cut into records split by split."""
    root = w.folder_for("events")
    rows = w.raw_events.withColumn("session_id", F.concat("session_id", F.lit('\n"s",')))
    sinks.write_landing(rows, root, "events", F.col("created_at"))
    return facts.events_fact(landing.read_typed_events(w.spark, f"{root}/events", split=True))


@query(
    "src5_manifest_round_trip",
    """SELECT created_at::DATE::VARCHAR AS source_date, 'events' AS source_table, count(*) AS rows_manifest
       FROM f_events GROUP BY 1""",
)
def _(w: Work) -> DataFrame:
    root = w.folder_for("manifests")
    sinks.write_manifests(sinks.manifest_counts({"events": (w.events_fact, F.col("created_at"))}), root)
    return landing.read_written_manifests(w.spark, root)


@query(
    "src6_typed_event_scan",
    "SELECT user_id, session_id, product_id, event_type, created_at::VARCHAR AS created_at FROM f_events",
)
def _(w: Work) -> DataFrame:
    """Events written as daily CSV partitions and scanned with a typed time."""
    root = w.folder_for("events")
    sinks.write_landing(w.raw_events, root, "events", F.col("created_at"))
    return facts.events_fact(landing.read_typed_events(w.spark, f"{root}/events"))


@query(
    "src8_query_scan",
    """SELECT o.order_id, u.city, o.total_amount::DOUBLE AS total_amount FROM c_orders o
       JOIN c_users u ON o.user_id = u.user_id WHERE o.status = 'completed'""",
)
def _(w: Work) -> DataFrame:
    return relational.read_query(
        w.spark,
        "SELECT o.order_id, u.city, o.total_amount FROM {orders} o"
        " JOIN {users} u ON o.user_id = u.user_id WHERE o.status = :status",
        {"orders": w.orders, "users": w.users},
        {"status": "completed"},
    )


@query(
    "src10_landed_counts",
    "SELECT source_date::VARCHAR AS source_date, source_table, rows_staging FROM n_staged",
)
def _(w: Work) -> DataFrame:
    return landing.landed_counts({t: w.staged(t) for t in ("orders", "order_items", "payments")})


@query(
    "snk4_slice_replace",
    """SELECT created_at::DATE::VARCHAR AS ds, event_type, count(*) AS events FROM f_events
       WHERE NOT (day(created_at) <= 10) OR (event_type = 'purchase' AND day(created_at) % 2 = 0) GROUP BY 1, 2""",
)
def _(w: Work) -> DataFrame:
    """All events, then days 1 to 10 replaced: even days by their purchases, odd days by nothing."""
    path = w.folder_for("events_fact")
    sinks.write_fact(w.events_fact, path, "events_fact")
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    day = F.dayofmonth("created_at")
    fresh = w.events_fact.where((day <= 10) & (day % 2 == 0) & (F.col("event_type") == "purchase"))
    sinks.write_fact(fresh, path, "events_fact", days)
    return w.spark.read.parquet(path).groupBy("ds", "event_type").agg(F.count("*").alias("events"))


@query(
    "snk6_dim_version_append",
    """SELECT user_id, email, is_active::BOOLEAN::BIGINT AS is_active FROM d_users""",
)
def _(w: Work) -> DataFrame:
    """A dimension appended as it stood before and after the repeated deliveries."""
    path = w.folder_for("users_dim")
    first_only = w.staged("users").where(~F.col("email").startswith("new-"))
    for n, staged in enumerate([first_only, w.staged("users")]):
        users = promote.promote_users(promote.type_users(staged, uuid_ids=False))
        version = F.lit(f"2024-01-0{n + 1}").cast("timestamp_ntz").alias("updated_at")
        sinks.append(facts.users_dim(users).select("*", version), path)
    current = copies.latest_version(w.spark.read.parquet(path), ["user_id"], "updated_at")
    return current.select("user_id", "email", "is_active")


@query(
    "snk13_daily_dataset",
    """SELECT registration_date::VARCHAR AS registered, count(*) AS users FROM c_users GROUP BY 1""",
)
def _(w: Work) -> DataFrame:
    """Users written to the landing zone by registration month and read back with their slice."""
    root = w.folder_for("landing")
    sinks.write_landing(w.users, root, "users", F.trunc("registration_date", "MM"))
    landed = landing.read_entity_layout(w.spark, root, "users", RUN_TIME, "batch-1")
    same_slice = F.trunc(F.col("registration_date").cast("date"), "MM") == F.col("_source_date")
    return landed.where(same_slice).groupBy(F.col("registration_date").alias("registered")).agg(F.count("*").alias("users"))


@query("snk8_audit_upsert", AUDIT_SQL)
def _(w: Work) -> DataFrame:
    """The audit is written twice; the second write replaces its lines."""
    path = w.folder_for("load_audit")
    counted = landing.landed_counts({t: w.staged(t) for t in w.verdicts})
    wrong = ("rows_promoted", "rows_rejected", "rows_conflict_skipped", "rows_manifest")
    first = counted.withColumns({c: F.lit(-1).cast("bigint") for c in wrong})
    by_month = lambda rows: rows.withColumn("ds", F.trunc("source_date", "MM")).hint("rebalance", "ds")
    sinks.replace_slices(by_month(first), path, ["ds"])
    sinks.replace_slices(by_month(w.audit), path, ["ds"])
    return w.spark.read.parquet(path).drop("ds")


@query(
    "snk12_event_retention",
    """SELECT order_id, created_at::VARCHAR AS created_at FROM c_orders
       WHERE created_at + INTERVAL 24 MONTH > TIMESTAMP '2001-01-31 00:00:00'""",
)
def _(w: Work) -> DataFrame:
    return w.orders.where(D.not_expired("created_at", "2001-01-31", 24)).select("order_id", "created_at")


# ---- incremental and streaming -------------------------------------------------------------


@query("str1_stream_funnel_totals", "SELECT day::VARCHAR AS day, views, carts, purchases FROM m_funnel")
def _(w: Work) -> DataFrame:
    """Running totals per day in stream state, changed days replaced in the mart."""
    root = w.folder_for("stream")
    events = facts.events_fact(w.streamed("events").raw_events)
    incremental.run_funnel_stream(events, f"{root}/mart", f"{root}/checkpoint")
    return w.spark.read.parquet(f"{root}/mart").select("day", "views", "carts", "purchases")


def _ingest(w: Work, table: str, rows: DataFrame) -> str:
    root = w.folder_for("ingest")
    incremental.run_fact_ingest(rows, table, root, f"{root}/checkpoint")
    return root


@query("str1_ingest_events", "SELECT day::VARCHAR AS day, views, carts, purchases FROM m_funnel")
def _(w: Work) -> DataFrame:
    root = _ingest(w, "events_fact", facts.events_fact(w.streamed("events").raw_events))
    return marts.funnel_merge(w.spark.read.parquet(f"{root}/funnel_daily"))


@query(
    "str1_ingest_session_levels",
    "SELECT level::BIGINT AS level, count(*) AS sessions FROM w_session_levels GROUP BY 1",
)
def _(w: Work) -> DataFrame:
    """The funnel from the mart that the event stream keeps."""
    root = _ingest(w, "events_fact", facts.events_fact(w.streamed("events").raw_events))
    return funnel.level_histogram(marts.session_levels_merge(w.spark.read.parquet(f"{root}/session_funnel_cells")))


@query("str1_ingest_orders", "SELECT day::VARCHAR AS day, gmv::DOUBLE AS gmv, orders FROM m_gmv")
def _(w: Work) -> DataFrame:
    rows = facts.orders_fact(w.streamed("orders").orders, w.users, w.order_items)
    root = _ingest(w, "orders_fact", rows)
    return marts.daily_gmv_merge(w.spark.read.parquet(f"{root}/daily_gmv")).drop("buyers")


@query(
    "str1_ingest_items",
    """SELECT c.day::VARCHAR AS day, c.category_id::BIGINT AS category_id, c.revenue::DOUBLE AS revenue,
              count(f.user_id) AS first_buyers
       FROM m_category c LEFT JOIN (SELECT user_id, category_id, min(order_created_at)::DATE AS day FROM f_items GROUP BY 1, 2) f
         ON f.category_id = c.category_id AND f.day = c.day GROUP BY 1, 2, 3""",
)
def _(w: Work) -> DataFrame:
    """Both item marts of one ingest: revenue and first buyers per day and category."""
    rows = facts.order_items_fact(w.streamed("lineitem").order_items, w.orders, w.products, w.categories)
    root = _ingest(w, "order_items_fact", rows)
    revenue = marts.category_revenue_merge(w.spark.read.parquet(f"{root}/category_revenue_daily"))
    first = marts.first_buy_merge(w.spark.read.parquet(f"{root}/user_category_first_buy"))
    buyers = first.groupBy(F.to_date("first_buy").alias("day"), "category_id").agg(F.count("*").alias("n"))
    return revenue.join(buyers, ["day", "category_id"], "left").select(
        "day", "category_id", "revenue", F.coalesce("n", F.lit(0)).alias("first_buyers")
    )


@query(
    "str1_two_stream_items",
    """SELECT order_item_id, order_id, order_created_at::VARCHAR AS order_created_at, user_id, product_id,
              category_id::BIGINT AS category_id, quantity::BIGINT AS quantity, line_revenue::DOUBLE AS line_revenue FROM f_items""",
)
def _(w: Work) -> DataFrame:
    """Item facts joined from a stream of items and a stream of orders; source lines ship years from their order."""
    root, lines = w.folder_for("two"), w.streamed("lineitem")
    delivered = lines.table("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        F.col("l_shipdate").alias("landed_at"),
    )
    rows = two_streams.items_fact(
        delivered, w.streamed("orders").orders, w.products, w.categories, "landed_at", "3000 days", "1 day"
    )
    two_streams.run_item_ingest(rows, root, f"{root}/checkpoint")
    return w.spark.read.parquet(f"{root}/order_items_fact").select(
        "order_item_id", "order_id", "order_created_at", "user_id", "product_id", "category_id", "quantity", "line_revenue"
    )


@query(
    "str1_two_stream_orders",
    """SELECT order_id, user_id, created_at::VARCHAR AS created_at, status, items_count, user_city FROM f_orders""",
)
def _(w: Work) -> DataFrame:
    """Order facts whose item counts were summed batch by batch."""
    parts = [two_streams.items_per_order(p) for p in in_parts(w.items_by_order)]
    merged = two_streams.orders_fact_merge(w.orders, w.users, w.keep("counts", quality.union_all(parts)))
    return merged.select("order_id", "user_id", "created_at", "status", "items_count", "user_city")


@query(
    "pl8_stream_audit",
    """SELECT created_at::DATE::VARCHAR AS source_date, 'events' AS source_table, count(*) AS rows_staging, count(*) AS rows_manifest,
              'success' AS status FROM f_events GROUP BY 1""",
)
def _(w: Work) -> DataFrame:
    """Every day of events landed with its manifest, streamed in and audited."""
    raw, root = w.folder_for("landing"), w.folder_for("audited")
    sinks.write_landing(w.raw_events, raw, "events", F.col("created_at"))
    sinks.write_manifests(sinks.manifest_counts({"events": (w.raw_events, F.col("created_at"))}), raw)
    audited.run_audited_events(w.spark, raw, root, f"{root}/checkpoint")
    lines = w.spark.read.schema(audited.AUDIT).parquet(f"{root}/stream_audit")
    return lines.groupBy("source_date", "source_table", "status").agg(
        F.sum("rows_staging").alias("rows_staging"), F.max("rows_manifest").alias("rows_manifest")
    )


@query(
    "str4_events_without_repeats",
    "SELECT DISTINCT user_id, session_id, product_id, event_type, created_at::VARCHAR AS created_at FROM f_events",
)
def _(w: Work) -> DataFrame:
    return facts.without_repeats(w.events_fact.unionByName(w.events_fact))
