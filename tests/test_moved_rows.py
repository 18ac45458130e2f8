"""Steps of a run that move keys in place of rows, or nothing: same results, and no shuffle where none is needed."""

import re
from datetime import date, datetime

from pyspark.sql import functions as F

from marketlane.operators.classify import first_seen, lookup_key, lookup_unknown, unknown_keys
from marketlane.operators.copies import mark_first
from marketlane.plans import pipeline, promote
from marketlane.schemas import LANDING_COLUMNS
from marketlane.session import FORCED_SPLIT, SPLITS, hot_keys_split, small_splits, split_bytes
from marketlane.sinks import tables as sinks
from marketlane.sources import landing, storage
from tests.shop_files import item, order, payment, product, user, write_categories, write_day

RUN = datetime(2025, 1, 10, 3)
D1, D2 = date(2025, 1, 1), date(2025, 1, 2)


def plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def lines(rows):
    return sorted(map(str, rows.select(*sorted(rows.columns)).collect()))


def landed(spark, entity, rows):
    names = LANDING_COLUMNS[entity]
    frame = spark.createDataFrame([(*[r.get(c) for c in names], day) for r, day in rows], ", ".join(f"{c} string" for c in names) + ", _source_date date")
    return landing.stamp(frame, F.col("_source_date"), RUN, "run-1")


def test_unknown_keys_answer_as_known_ones(spark):
    rows = spark.createDataFrame([(i, k, d) for i, (k, d) in enumerate([("a", D1), ("a", D2), ("b", D1), ("b", D2), (None, D1), ("x", D2), ("x", D2), ("x", None)] * 3)], "n int, id string, day date")
    known = spark.createDataFrame([("a", D1), ("b", D2), ("c", D1)], "id string, first_ds date")
    want = {r.n: bool(r.ok) for r in lookup_key(rows, "id", known, "id", "ok", "day").collect()}
    pairs = unknown_keys(rows, "id", known, "id", "day")
    assert sorted(pairs.collect(), key=str) == sorted([("b", D1), ("x", D2), ("x", None)], key=str)
    found = lookup_unknown(rows, "id", pairs, "ok", "day")
    assert {r.n: r.ok for r in found.collect()} == want and found.columns == [*rows.columns, "ok"]


def test_lookup_keeps_columns_and_types(spark):
    rows = spark.createDataFrame([(7, 1, D1), (None, 2, D1), (9, 3, D1)], "id bigint, n int, day date")
    known = spark.createDataFrame([(7, D1)], "id bigint, first_ds date")
    out = lookup_key(rows, "id", known, "id", "ok", "day")
    assert out.dtypes == [*rows.dtypes, ("ok", "boolean")]
    assert sorted((r.n, r.id, r.ok) for r in out.collect()) == [(1, 7, True), (2, None, False), (3, 9, False)]


def test_only_copies_compete(spark):
    base = {"created_at": "2025-01-01 10:00:00", "status": "completed", "total_amount": "5", "user_id": "u"}
    orders = [({**base, "order_id": f"o{i % 7}", "promo_code": str(i % 3)}, D1 if i % 2 else D2) for i in range(20)]
    orders += [({**base, "order_id": f"s{i}"}, D1) for i in range(5)] + [({**base, "order_id": None}, D1)] * 3
    orders += [({**base, "order_id": "o1", "user_id": None}, D1), ({**base, "order_id": "s1", "user_id": "ghost"}, D1)]
    staged = landed(spark, "orders", orders)
    users = spark.createDataFrame([("u", D1)], "user_id string, first_ds date")
    stored = {}
    keep = lambda name, rows: stored.setdefault(name, rows)
    want = promote.classify_orders(staged, users)
    unknown = unknown_keys(staged, "user_id", users, "user_id", "_source_date")
    assert lines(promote.classify_orders(staged, None, unknown_users=unknown, keep=keep)) == lines(want)
    assert {r.order_id for r in stored["copied_orders"].collect()} == {f"o{i}" for i in range(7)}
    paid = [({"payment_id": p, "order_id": "o1", "amount": a, "processed_at": "2025-01-01 10:00:00"}, d) for p, a, d in [("p1", "1", D2), ("p1", "2", D1), ("p1", "2", D1), ("p2", "3", D1), (None, "4", D1), (None, "5", D1)]]
    judged = landed(spark, "payments", paid).withColumn("reject_reason", F.lit(None).cast("string"))
    assert lines(promote.split_payments(judged, uuid_ids=False, keep=keep).accepted) == lines(promote.split_payments(judged, uuid_ids=False).accepted)


def test_few_slices_are_not_gathered(spark):
    rows = spark.range(10).withColumn("ds", F.lit(D1))
    assert "Exchange" not in plan(sinks.gathered(rows, 60, "ds")) and "Exchange" in plan(sinks.gathered(rows, sinks.MOST_FILES, "ds"))


def test_compressed_landing_reads_alike(spark, tmp_path):
    rows = spark.createDataFrame([(str(i), 'a "b"\n, c', "") for i in range(50)], "category_id string, name string, parent_id string")
    for name, how in (("plain", {}), ("gz", {"slices": 1, "compression": "gzip"})):
        sinks.write_landing(rows, str(tmp_path / name), "categories", F.lit(D1), **how)
    assert all(name.endswith(".csv.gz") for name, _ in storage.files(spark, [str(tmp_path / "gz")]))
    read = [lines(landing.read_entity_layout(spark, str(tmp_path / n), "categories", RUN, "b").drop("_batch_id")) for n in ("plain", "gz")]
    assert read[0] == read[1] and len(read[0]) == 50


def test_a_delivery_without_facts_leaves_history_alone(spark, tmp_path):
    raw, wh = tmp_path / "raw", pipeline.Warehouse(spark, str(tmp_path / "wh"))
    write_categories(raw)
    first, second = "2025-01-01", "2025-01-02"
    write_day(raw, first, users=[user(1, first)], products=[product(1, first)], orders=[order(1, 1, first)], order_items=[item(1, 1, 1)], payments=[payment(1, 1, first)])
    write_day(raw, second, users=[user(2, second)], products=[], orders=[], order_items=[], payments=[])
    pipeline.run_days(spark, str(raw), wh, [first, second], RUN)
    before = {t: lines(wh.read(f"facts/{t}")) for t in ("orders_fact", "order_items_fact", "payments_fact")}
    # Nothing of the history is read, so nothing of it is moved.
    for rows in (wh.slices("core/orders", [second]), *pipeline._delivered_with(wh.read("core/orders"), wh.read("core/order_items"), [second])):
        assert "FileScan" not in plan(rows) and rows.count() == 0
    assert "FileScan" not in plan(pipeline._fact_days(wh, [second]))
    assert wh.slices("core/orders", [first, second]).count() == 1
    pipeline.run_days(spark, str(raw), wh, [second], RUN)
    assert before == {t: lines(wh.read(f"facts/{t}")) for t in before}
    assert wh.read("core/users_deliveries").count() == 2


def test_slices_without_rows_go_below_any_leading_partition(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = spark.createDataFrame([(1, D1), (2, D2)], "n int, ds date").withColumn("month", F.lit(202501))
    sinks.replace_slices(rows, path, ["month", "ds"], ["2025-01-01", "2025-01-02"])
    sinks.replace_slices(rows.where("n = 2"), path, ["month", "ds"], ["2025-01-01", "2025-01-02", "2025-01-03"])
    assert storage.children(spark, f"{path}/month=202501") == ["ds=2025-01-02"]


def test_splits_are_small_inside_only(spark):
    before = spark.conf.get(SPLITS)
    with small_splits(spark):
        assert split_bytes(spark) <= 32 << 20
    assert spark.conf.get(SPLITS) == before


def as_uuid(name: str) -> str:
    return f"00000000-0000-0000-0000-{name.encode().hex():0>12}"


def judged_items(spark, rows, mark):
    staged = landed(spark, "order_items", rows)
    products = unknown_keys(staged, "product_id", spark.createDataFrame([(as_uuid("p"), D1)], "product_id string, first_ds date"), "product_id", "_source_date")
    orders = spark.createDataFrame([(as_uuid(f"o{i}"), D2 if i == 4 else D1) for i in range(5)], "order_id string, first_ds date")
    return promote.classify_items(staged, None, orders, unknown_products=products, mark=mark)


def test_marked_items_give_the_same_winners(spark):
    ids = [as_uuid("j"), as_uuid("k"), as_uuid("j").upper(), None, as_uuid("l")]
    names = lambda order, product: {"order_id": order and as_uuid(order), "product_id": as_uuid(product)}
    rows = [
        ({"order_item_id": ids[i % 5], **names(f"o{i % 6}" if i % 11 else None, "p" if i % 7 else "x"), "quantity": str(i % 4 - 1), "unit_price": str(i % 3)}, D1 if i % 2 else D2)
        for i in range(120)
    ]
    rows += [({"order_item_id": as_uuid(f"s{i // 3}"), **names(f"o{i // 3 % 4}", "p"), "quantity": "1", "unit_price": str(i % 2)}, D2) for i in range(30)]
    for uuid_ids in (False, True):
        stored = {}
        keep = lambda name, frame: stored.setdefault(name, frame)
        want = promote.split_items(judged_items(spark, rows, False), uuid_ids=uuid_ids)
        got = promote.split_items(judged_items(spark, rows, True), uuid_ids=uuid_ids, keep=keep)
        assert lines(got.accepted) == lines(want.accepted) and got.accepted.columns == want.accepted.columns
        assert lines(got.rejected) == lines(want.rejected)
        # Copies inside one order are told apart before; only ids of several orders are still compared.
        several = {i for i in ids if i and not (uuid_ids and i.isupper())}
        assert {r.order_item_id for r in stored["copied_order_item_id"].collect()} == several


def test_items_are_marked_where_they_meet_their_orders(spark):
    n = F.col("id")
    order = F.when(n % 3 == 0, "hot").when(n % 10 == 1, None).otherwise(F.concat(F.lit("o"), (n / 4).cast("int")))
    rows = spark.range(0, 30_000, 1, 8).select((n % 20_000).cast("string").alias("item"), order.alias("order_id"), F.lit(D1).alias("day"))
    known = first_seen(rows.where("order_id is not null").select("order_id", F.col("day").alias("_source_date")), "order_id")
    found = lookup_key(rows, "order_id", known, "order_id", "ok", "day", probe=True)
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
    }
    before = {k: spark.conf.get(k) for k in [*changed, FORCED_SPLIT]}
    mark = lambda: mark_first(found, "_probe", "item", ["day"], F.col("ok"), "first")
    want = found.where("ok").select("_probe", "item").distinct().count()
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        moved = lambda frame: len(re.findall("Exchange hashpartitioning", plan(frame)))
        assert moved(mark()) == moved(found)
        with hot_keys_split(spark):
            out = mark()
            assert sum(r.first for r in out.collect()) == want
            assert "SortMergeJoin(skew=true)" in plan(out)
        assert spark.conf.get(FORCED_SPLIT) == before[FORCED_SPLIT]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
