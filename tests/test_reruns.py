"""Deliveries that are loaded again, spellings of one key, and text that CSV must keep."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marketlane.operators import cohorts, percentiles
from marketlane.operators.quality import QualityError
from marketlane.plans import marts, pipeline
from marketlane.plans.pipeline import Warehouse
from marketlane.schemas import LANDING_COLUMNS
from marketlane.sinks import tables as sinks
from marketlane.sources import landing
from tests.shop_files import item, order, payment, product, uid, user, write_categories, write_day

RUN = datetime(2025, 1, 10, 3)
DAY, NEXT = "2025-01-01", "2025-01-02"


def day(root, ds=DAY, **entities):
    base = {"users": [user(1, ds)], "products": [product(1, ds)], "orders": [order(1, 1, ds)],
            "order_items": [item(1, 1, 1)], "payments": [payment(1, 1, ds)]}
    write_categories(root)
    write_day(root, ds, **{**base, **entities})


def audit(wh):
    lines = wh.read("dq/load_audit").collect()
    return {(str(r.source_date), r.source_table): (r.rows_staging, r.rows_promoted, r.rows_rejected) for r in lines}


def test_a_gate_never_passes_on_the_lines_of_an_earlier_run(spark, tmp_path):
    raw, wh = tmp_path / "raw", Warehouse(spark, str(tmp_path / "wh"))
    day(raw)
    pipeline.load_core(spark, str(raw), wh, [DAY], RUN)
    assert set(audit(wh).values()) == {(1, 1, 0)}
    announced = {"orders": 1, "order_items": 1, "payments": 1}
    day(raw, orders=[], order_items=[], payments=[], manifest=announced)
    with pytest.raises(QualityError, match="rows lost: 3 days and tables"):
        pipeline.load_core(spark, str(raw), wh, [DAY], RUN)


def test_every_day_and_table_has_a_line(spark, tmp_path):
    raw, wh = tmp_path / "raw", Warehouse(spark, str(tmp_path / "wh"))
    day(raw, order_items=[], payments=[])
    pipeline.load_core(spark, str(raw), wh, [DAY], RUN)
    assert audit(wh) == {(DAY, "orders"): (1, 1, 0), (DAY, "order_items"): (0, 0, 0), (DAY, "payments"): (0, 0, 0)}


@pytest.mark.parametrize("together", [True, False])
def test_slices_that_removed_rows_leave_are_refreshed(spark, tmp_path, together):
    raw, wh = tmp_path / "raw", Warehouse(spark, str(tmp_path / "wh"))
    day(raw)
    late = order(2, 1, DAY)
    paid = [payment(1, 1, DAY), payment(2, 2, DAY)]
    write_day(raw, NEXT, orders=[late], order_items=[item(2, 2, 1)], payments=paid[1:])
    pipeline.run_days(spark, str(raw), wh, [DAY, NEXT], RUN)
    gmv = lambda: {str(r.day): float(r.gmv) for r in marts.daily_gmv_merge(wh.read("marts/daily_gmv")).collect()}
    assert gmv() == {DAY: 200.0}
    write_day(raw, NEXT, orders=[], order_items=[], payments=[])
    if together:
        pipeline.run_days(spark, str(raw), wh, [NEXT], RUN)
    else:
        pipeline.load_core(spark, str(raw), wh, [NEXT], RUN)
        pipeline.load_facts(spark, str(raw), wh, [NEXT], RUN)
    assert gmv() == {DAY: 100.0}
    for table in ("orders_fact", "order_items_fact", "payments_fact"):
        assert wh.read(f"facts/{table}").count() == 1
    assert not wh.has(pipeline.LEFT_SLICES)


def test_spellings_of_one_id_are_one_key(spark, tmp_path):
    raw, wh = tmp_path / "raw", Warehouse(spark, str(tmp_path / "wh"))
    def loud(row, key):
        return {**row, key: "{" + row[key].upper() + "}"}

    day(
        raw,
        orders=[order(1, 1, DAY), loud(order(1, 1, DAY, created_at=f"{DAY} 12:00:00"), "order_id")],
        order_items=[item(10, 1, 1), loud(item(10, 1, 1), "order_item_id")],
        payments=[payment(10, 1, DAY), loud(payment(10, 1, DAY), "payment_id")],
    )
    pipeline.load_core(spark, str(raw), wh, [DAY], RUN)
    for table, key, n in (("orders", "order_id", 1), ("order_items", "order_item_id", 10), ("payments", "payment_id", 10)):
        assert [r[key] for r in wh.read(f"core/{table}").collect()] == [uid({"orders": "o", "order_items": "i", "payments": "y"}[table], n)]
    assert {r.rows_conflict_skipped for r in wh.read("dq/load_audit").collect()} == {1}


TEXTS = ["  padded  ", 'say "hi"', "two\nlines", "a,b", "tab\tand \r return", "", None, "\\ back"]


def test_text_survives_csv(spark, tmp_path):
    rows = [(str(k), t, None) for k, t in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, "category_id string, name string, parent_id string")
    want = sorted((k, t or None) for k, t, _ in rows)
    sinks.write_monolith(frame, str(tmp_path / "m"), "categories", first=True)
    assert sorted((r.category_id, r.name) for r in landing.read_monolith(spark, str(tmp_path / "m"), "categories").collect()) == want
    sinks.write_landing(frame, str(tmp_path / "l"), "categories", F.lit(DAY))
    got = landing.read_entity_layout(spark, str(tmp_path / "l"), "categories", RUN, "b")
    assert sorted((r.category_id, r.name) for r in got.collect()) == want


@pytest.mark.parametrize("line", ["1,Books", "1,Books,,extra"])
def test_a_wrong_number_of_fields_stops_the_read(spark, tmp_path, line):
    path = tmp_path / "categories.csv"
    path.write_text(",".join(LANDING_COLUMNS["categories"]) + f"\n{line}\n")
    rows = landing.read_csv(spark, "categories", str(path))
    for action in (rows.collect, rows.select("name").collect, rows.count):
        with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
            action()


def test_an_offset_that_is_not_listed_fails(spark):
    long = spark.createDataFrame([("2024-01", k, 1) for k in (0, 79, 80)], "cohort string, month_offset int, users long")
    assert sum(v for k, v in cohorts.retention_matrix(long, range(81)).first().asDict().items() if k != "cohort") == 3
    with pytest.raises(Exception, match="month offset not listed: 80"):
        cohorts.retention_matrix(long, range(80)).collect()


@pytest.mark.parametrize("value", ["-1.0", "0.125", "123456789012.0"])
def test_percentiles_refuse_what_their_digits_cannot_hold(spark, value):
    rows = spark.createDataFrame([(1.0,), (float(value),)], "v double").select(F.col("v").cast("decimal(20,3)").alias("v"))
    with pytest.raises(Exception, match="is not a number of 12 digits"):
        percentiles.percentiles(rows, "v", {"p50": 0.5}, scale=2).collect()
