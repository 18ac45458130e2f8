import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marketlane.operators.quality import QualityError
from marketlane.plans import marts, pipeline
from marketlane.plans.pipeline import Warehouse
from marketlane.sources import landing, storage
from tests.shop_files import (
    event, item, order, ordered_runs, payment, product, random_history, uid, user,
    write_categories, write_day,
)

RUN = datetime(2025, 1, 10, 3)
DAYS = [f"2025-01-{d:02d}" for d in range(1, 4)]


def write_history(root, history):
    write_categories(root)
    for ds, day in history.items():
        write_day(root, ds, **day)


def tables(wh):
    """Comparable content of core, quarantine and marts."""
    core = {t: sorted(map(tuple, wh.read(f"core/{t}").collect()), key=repr) for t in ("orders", "order_items", "payments")}
    rejects = wh.read("dq/rejected_rows").select(
        "source_table", F.col("source_date").cast("string"), "reason",
        F.regexp_extract("raw_data", r'^\{"[a-z_]+":"([^"]+)"', 1),
    )
    core["rejects"] = sorted(map(tuple, rejects.collect()))
    core["users"] = sorted(map(tuple, wh.users().collect()))
    for t in ("orders_fact", "order_items_fact", "payments_fact", "events_fact"):
        core[t] = sorted(map(repr, wh.read(f"facts/{t}").collect()))
    core["gmv"] = sorted(map(tuple, marts.daily_gmv_merge(wh.read("marts/daily_gmv")).collect()))
    core["funnel"] = sorted(map(tuple, marts.funnel_merge(wh.read("marts/funnel_daily")).collect()))
    core["first_buy"] = sorted(map(tuple, marts.first_buy_merge(wh.read("marts/user_category_first_buy")).collect()))
    core["users_dim"] = sorted(map(tuple, wh.dim("users_dim").drop("updated_at").collect()))
    return core


@pytest.fixture(scope="module")
def history(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    history = random_history(7, DAYS)
    write_history(root, history)
    return root, history


@pytest.fixture(scope="module")
def backfilled(spark, history, tmp_path_factory):
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("wh")))
    assert pipeline.backfill(spark, str(history[0]), wh, RUN) == "success"
    return wh


def test_backfill_equals_model_of_ordered_runs(backfilled, history):
    core, rejects = ordered_runs(history[1])
    got = tables(backfilled)
    assert got["rejects"] == rejects
    orders = {r.order_id: (r._source_date.isoformat(), str(r.created_at)) for r in backfilled.read("core/orders").collect()}
    assert orders == core["orders"]
    for t, key in (("order_items", "order_item_id"), ("payments", "payment_id")):
        rows = {r[key]: r._source_date.isoformat() for r in backfilled.read(f"core/{t}").collect()}
        assert rows == core[t]
    assert {r[2] for r in rejects} == {
        "null_user_id", "orphan_user", "duplicate_pk", "null_product_id",
        "orphan_product", "negative_quantity", "orphan_order",
    }


def test_daily_runs_equal_backfill_and_can_be_repeated(spark, backfilled, history, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for ds in DAYS:
        assert pipeline.run_days(spark, str(history[0]), wh, [ds], RUN) == "success"
    want = tables(backfilled)
    assert tables(wh) == want
    assert pipeline.run_days(spark, str(history[0]), wh, [DAYS[1]], RUN) == "success"
    assert tables(wh) == want
    assert storage.children(spark, wh.path("_work")) == []


def test_audit_adds_up_and_core_is_sound(backfilled, history):
    audit = backfilled.read("dq/load_audit")
    lines = audit.collect()
    assert len(lines) == len(DAYS) * 3
    for r in lines:
        assert r.rows_staging == r.rows_promoted + r.rows_rejected + r.rows_conflict_skipped
        assert r.rows_manifest == r.rows_staging
    assert sum(r.rows_conflict_skipped for r in lines) > 0
    pipeline.check_core(backfilled)


def test_quarantine_keeps_null_fields(backfilled):
    rows = backfilled.read("dq/rejected_rows").where("reason = 'null_user_id'").collect()
    assert rows
    for r in rows:
        payload = json.loads(r.raw_data)
        assert payload["user_id"] is None
        assert list(payload)[-3:] == ["_source_date", "_loaded_at", "_batch_id"]


def test_etl_log_covers_every_table(backfilled):
    logged = {r.target_table: r.rows for r in backfilled.read("ops/etl_log").collect()}
    assert set(logged) == {
        "users_dim", "products_dim", "orders_fact", "order_items_fact", "payments_fact", "events_fact", "ALL",
    }
    assert logged["orders_fact"] == backfilled.read("core/orders").count()


def one_day(root, ds="2025-01-01", **entities):
    base = {"users": [user(1, ds)], "products": [product(1, ds)], "orders": [order(1, 1, ds)],
            "order_items": [item(1, 1, 1)], "payments": [payment(1, 1, ds)]}
    write_categories(root)
    write_day(root, ds, **{**base, **entities})


def test_reason_priority(spark, tmp_path):
    ds = "2025-01-01"
    orders = [
        order(1, 1, ds), order(1, 1, ds, created_at=f"{ds} 10:20:00"),
        order(2, None, ds), order(3, 99, ds),
        order(4, None, ds), order(4, 1, ds, created_at=f"{ds} 11:00:00"),  # one copy survives
    ]
    items = [
        item(1, 1, 1), item(2, 1, None, -1), item(3, 99, 77, -1), item(4, 99, 1, -1), item(5, 2, 1), item(6, 4, 1),
    ]
    one_day(tmp_path / "raw", orders=orders, order_items=items,
            payments=[payment(1, 1, ds), payment(2, 2, ds), payment(3, 4, ds)])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    pipeline.load_core(spark, str(tmp_path / "raw"), wh, [ds], RUN)
    reasons = sorted((r.source_table, r.reason) for r in wh.read("dq/rejected_rows").collect())
    assert reasons == sorted(
        [
            ("orders", "duplicate_pk"), ("orders", "null_user_id"), ("orders", "orphan_user"), ("orders", "null_user_id"),
            ("order_items", "null_product_id"), ("order_items", "orphan_product"),
            ("order_items", "negative_quantity"), ("order_items", "orphan_order"), ("payments", "orphan_order"),
        ]
    )
    kept = {r.order_id: str(r.created_at) for r in wh.read("core/orders").collect()}
    assert kept == {uid("o", 1): f"{ds} 10:00:00", uid("o", 4): f"{ds} 11:00:00"}


def test_upsert_keeps_first_value_of_fixed_columns(spark, tmp_path):
    raw, wh = tmp_path / "raw", Warehouse(spark, str(tmp_path / "wh"))
    one_day(raw)
    later = user(1, "2025-01-01", email="new@x.example", city="Moved", is_active="False", full_name="")
    write_day(raw, "2025-01-02", users=[later], products=[product(1, "2025-01-01", price="99.00", name="Other")])
    for ds in ("2025-01-01", "2025-01-02"):
        pipeline.load_core(spark, str(raw), wh, [ds], RUN)
    row = wh.users().first()
    assert (row.email, row.city, row.is_active, row.full_name) == ("new@x.example", "City 1", False, None)
    row = wh.products().first()
    assert (str(row.price), row.name) == ("99.00", 'Item "1"')
    assert str(row.first_ds) == "2025-01-01"


def test_missing_day_is_skipped_and_missing_file_is_empty(spark, tmp_path):
    raw, wh = tmp_path / "raw", Warehouse(spark, str(tmp_path / "wh"))
    one_day(raw)
    assert pipeline.run_days(spark, str(raw), wh, ["2025-01-05"], RUN) == "skipped"
    (raw / "2025-01-01" / "payments.csv").unlink()
    (raw / "2025-01-01" / "manifest.json").unlink()
    assert pipeline.run_days(spark, str(raw), wh, ["2025-01-01"], RUN) == "success"
    assert wh.read("core/orders").count() == 1
    assert not wh.has("facts/events_fact")


def test_rerun_with_fewer_rows_empties_the_slice(spark, tmp_path):
    raw, wh = tmp_path / "raw", Warehouse(spark, str(tmp_path / "wh"))
    ds = "2025-01-01"
    one_day(raw, events=[event(1, 1, "view", f"{ds} 10:00:00")])
    write_day(raw, "2025-01-02", orders=[order(2, 1, "2025-01-02")], users=[])
    pipeline.run_days(spark, str(raw), wh, [ds, "2025-01-02"], RUN)
    assert wh.read("facts/orders_fact").count() == 2
    one_day(raw, orders=[], order_items=[], payments=[], events=[])
    pipeline.run_days(spark, str(raw), wh, [ds], RUN)
    assert [str(r.created_at)[:10] for r in wh.read("facts/orders_fact").collect()] == ["2025-01-02"]
    assert wh.read("facts/events_fact").count() == 0
    assert [str(r.day) for r in wh.read("marts/daily_gmv").collect()] == ["2025-01-02"]


def test_lost_rows_stop_the_run(spark, tmp_path):
    one_day(tmp_path / "raw")
    write_day(tmp_path / "raw", "2025-01-01", manifest={"orders": 5}, users=[user(1, "2025-01-01")], orders=[order(1, 1, "2025-01-01")])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(QualityError, match="rows lost: 1 days and tables .*dq/shortfalls"):
        pipeline.load_core(spark, str(tmp_path / "raw"), wh, ["2025-01-01"], RUN)
    (line,) = spark.read.parquet(wh.path("dq/shortfalls")).collect()
    assert (str(line.source_date), line.source_table, line.rows_staging, line.rows_manifest) == ("2025-01-01", "orders", 1, 5)


@pytest.mark.parametrize(
    "change, table, message",
    [
        ({"orders": [order(1, 1, "2025-01-01", total_amount="-1.00")]}, "orders", "total_amount >= 0"),
        ({"order_items": [item(1, 1, 1, unit_price="-5")]}, "order_items", "unit_price >= 0"),
        ({"order_items": [item(1, 1, 1, quantity="")]}, "order_items", "quantity is null"),
        ({"users": [user(1, "2025-01-01", email="")]}, "users_deliveries", "email is null"),
        ({"products": [product(1, "2025-01-01", price="-3")]}, "products_deliveries", "price >= 0"),
        ({"orders": [order(1, 1, "2025-01-01", total_amount="abc")]}, "orders", "CAST_INVALID_INPUT"),
        ({"orders": [order(1, 1, "2025-01-01", order_id="12-bad")]}, "orders", "not a uuid"),
    ],
)
def test_broken_constraint_stops_before_the_write(spark, tmp_path, change, table, message):
    one_day(tmp_path / "raw", **change)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(Exception, match=message.replace("(", r"\(")):
        pipeline.load_core(spark, str(tmp_path / "raw"), wh, ["2025-01-01"], RUN)
    assert not any("=" in c for c in storage.children(spark, wh.path(f"core/{table}")))


def test_second_payment_and_unknown_category_stop_the_run(spark, tmp_path):
    ds = "2025-01-01"
    one_day(tmp_path / "a", payments=[payment(1, 1, ds), payment(2, 1, ds)])
    with pytest.raises(QualityError, match="payments.order_id unique"):
        pipeline.load_core(spark, str(tmp_path / "a"), Warehouse(spark, str(tmp_path / "wa")), [ds], RUN)
    one_day(tmp_path / "b", products=[product(1, ds, category_id="77.0")])
    with pytest.raises(QualityError, match="products.category_id foreign_key"):
        pipeline.load_core(spark, str(tmp_path / "b"), Warehouse(spark, str(tmp_path / "wb")), [ds], RUN)


def test_facts_need_a_core(spark, tmp_path):
    with pytest.raises(RuntimeError, match="core tables are missing"):
        pipeline.load_facts(spark, str(tmp_path), Warehouse(spark, str(tmp_path / "wh")), ["2025-01-01"], RUN)


def test_event_retention(spark, tmp_path):
    raw, wh = tmp_path / "raw", Warehouse(spark, str(tmp_path / "wh"))
    one_day(raw)
    times = {"2022-11-30": "2022-11-30 23:00:00", "2022-12-15": "2022-12-15 12:00:00", "2025-01-01": "2025-01-01 08:00:00"}
    for ds, ts in times.items():
        write_day(raw, ds, events=[event(1, 1, "view", ts)]) if ds != "2025-01-01" else one_day(raw, events=[event(1, 1, "view", ts)])
    pipeline.run_days(spark, str(raw), wh, list(times), RUN)
    left = [str(r.created_at) for r in pipeline.live_events(wh, "2024-12-15").collect()]
    assert sorted(left) == ["2022-12-15 12:00:00", "2025-01-01 08:00:00"]
    assert pipeline.expire_events(wh, "2024-12-31") == ["month=202211"]
    assert pipeline.expire_events(wh, "2025-01-01") == ["month=202212"]
    assert wh.read("facts/events_fact").count() == 1


def test_day_listing(spark, history):
    assert landing.day_partitions(spark, str(history[0])) == DAYS
