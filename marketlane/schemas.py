"""Fixed table layouts: landing (all text), core, facts, marts and operations."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Column order of the landing CSV files: the files are mapped by position.
LANDING_COLUMNS: dict[str, list[str]] = {
    "categories": ["category_id", "name", "parent_id"],
    "users": [
        "user_id", "email", "full_name", "registration_date",
        "acquisition_channel", "city", "age_group", "is_active",
    ],
    "products": [
        "product_id", "name", "category_id", "price", "cost_price",
        "rating", "is_available", "created_at",
    ],
    "orders": [
        "order_id", "user_id", "created_at", "status", "payment_method",
        "total_amount", "discount_amount", "promo_code",
    ],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "unit_price"],
    "payments": ["payment_id", "order_id", "amount", "method", "status", "processed_at"],
    "events": ["user_id", "session_id", "product_id", "event_type", "created_at"],
}

DIMENSIONS = ("categories", "users", "products")
FACTS = ("orders", "order_items", "payments")
# Stamped on every landed row: partition day, load time (UTC clock), run id.
META_COLUMNS = ("_source_date", "_loaded_at", "_batch_id")


def landing_schema(entity: str) -> T.StructType:
    """All-text layout of one landing file."""
    return T.StructType([T.StructField(c, T.StringType()) for c in LANDING_COLUMNS[entity]])


def columns_of(layout: str) -> list[str]:
    """Column names of a DDL text."""
    return re.findall(r"(?:^|, )\s*(\w+) ", layout)


CORE = {
    "categories": "category_id int, name string, parent_id int",
    "users": (
        "user_id string, email string, full_name string, registration_date date,"
        " acquisition_channel string, city string, age_group string, is_active boolean"
    ),
    "products": (
        "product_id string, name string, category_id int, price decimal(12,2),"
        " cost_price decimal(12,2), rating decimal(3,2), is_available boolean,"
        " created_at timestamp_ntz"
    ),
    "orders": (
        "order_id string, user_id string, created_at timestamp_ntz, status string,"
        " payment_method string, total_amount decimal(12,2), discount_amount decimal(12,2),"
        " promo_code string"
    ),
    "order_items": (
        "order_item_id string, order_id string, product_id string, quantity int,"
        " unit_price decimal(12,2)"
    ),
    "payments": (
        "payment_id string, order_id string, amount decimal(12,2), method string,"
        " status string, processed_at timestamp_ntz"
    ),
}

REJECTED_ROWS = (
    "source_table string, source_date date, reason string, raw_data string,"
    " rejected_at timestamp_ntz"
)
LOAD_AUDIT = (
    "source_date date, source_table string, run_id string, rows_staging bigint,"
    " rows_promoted bigint, rows_rejected bigint, rows_conflict_skipped bigint,"
    " rows_manifest bigint, started_at timestamp_ntz, finished_at timestamp_ntz, status string"
)
ETL_LOG = (
    "ts timestamp_ntz, dag_id string, task string, source_date date, target_table string,"
    " rows bigint, seconds float, status string"
)

FACT_TABLES = {
    "users_dim": (
        "user_id string, email string, full_name string, registration_date date,"
        " acquisition_channel string, city string, age_group string, is_active int,"
        " updated_at timestamp_ntz"
    ),
    "products_dim": (
        "product_id string, name string, category_id int, category_name string,"
        " parent_category string, price decimal(12,2), cost_price decimal(12,2),"
        " rating decimal(3,2), is_available int, updated_at timestamp_ntz"
    ),
    "orders_fact": (
        "order_id string, user_id string, created_at timestamp_ntz, status string,"
        " payment_method string, total_amount decimal(12,2), discount_amount decimal(12,2),"
        " items_count int, acquisition_channel string, user_city string, user_age_group string"
    ),
    "order_items_fact": (
        "order_item_id string, order_id string, order_created_at timestamp_ntz, user_id string,"
        " product_id string, category_id int, category_name string, quantity smallint,"
        " unit_price decimal(12,2), line_revenue decimal(18,2)"
    ),
    "events_fact": (
        "user_id string, session_id string, product_id string, event_type string,"
        " created_at timestamp_ntz"
    ),
    "payments_fact": (
        "payment_id string, order_id string, amount decimal(12,2), method string,"
        " status string, processed_at timestamp_ntz"
    ),
}

MARTS = {
    "daily_gmv": "day date, gmv_state decimal(22,2), orders_state bigint, buyers_state binary",
    "category_revenue_daily": (
        "day date, category_id int, category_name string, revenue decimal(18,2), items_sold bigint"
    ),
    "funnel_daily": "day date, views bigint, carts bigint, purchases bigint",
    "user_category_first_buy": "user_id string, category_id int, first_buy_state timestamp_ntz",
    "session_funnel_cells": "session_id string, cell bigint, s0 bigint, s1 bigint, s2 bigint",
}


def stored_layouts() -> dict[str, str]:
    """Layout of every warehouse table, partition columns included."""
    layouts = {}
    for name, layout in CORE.items():
        kind = name if name in FACTS else f"{name}_deliveries"
        layouts[f"core/{kind}"] = f"{layout}, _source_date date"
    for name, layout in FACT_TABLES.items():
        tail = "" if name.endswith("_dim") else ", month int, ds date"
        layouts[f"facts/{name}"] = layout + tail
    for name, layout in MARTS.items():
        layouts[f"marts/{name}"] = f"{layout}, ds date"
    layouts["dq/rejected_rows"] = REJECTED_ROWS
    layouts["dq/load_audit"] = f"{LOAD_AUDIT}, ds date"
    layouts["ops/etl_log"] = ETL_LOG
    return layouts


# Event-time column and storage sort key of each fact.
FACT_DAY_COLUMN = {
    "orders_fact": "created_at",
    "order_items_fact": "order_created_at",
    "events_fact": "created_at",
    "payments_fact": "processed_at",
}
FACT_SORT_KEY = {
    "orders_fact": ["created_at", "user_id"],
    "order_items_fact": ["order_created_at", "order_id"],
    "events_fact": ["created_at", "user_id", "session_id"],
    "payments_fact": ["processed_at", "order_id"],
}

# Fixed values of the published data contract.
NO_CATEGORY_ID = 0
NO_CATEGORY_NAME = "Без категории"
SEGMENT_PROMO = "промокод"
SEGMENT_NO_PROMO = "без промо"
FUNNEL_STEPS = ("view", "cart", "purchase")
FUNNEL_WINDOW_SECONDS = 86400
EVENT_RETENTION_MONTHS = 24
