"""A stream of landing days that is held against its manifests batch by batch."""

import pytest
from pyspark.sql import functions as F

from marketlane.operators.quality import QualityError
from marketlane.streaming import audited
from tests.shop_files import event, write_day

DAYS = ["2025-01-01", "2025-01-02", "2025-01-03", "2025-01-04"]


def land(root, announced=None):
    for n, ds in enumerate(DAYS):
        rows = [event(k, 1, "view", f"{ds} 10:00:{k:02d}") for k in range(3 + n)]
        write_day(root, ds, manifest=(announced or {}).get(ds), events=rows)


def audit(spark, root):
    rows = spark.read.schema(audited.AUDIT).parquet(f"{root}/stream_audit").collect()
    return sorted((str(r["source_date"]), r["rows_staging"], r["rows_manifest"], r["status"]) for r in rows)


def facts_per_day(spark, root):
    rows = spark.read.parquet(f"{root}/events_fact").groupBy("_source_date").count().collect()
    return sorted((str(r["_source_date"]), r["count"]) for r in rows)


def test_complete_days_are_audited_and_logged(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "root")
    land(raw)
    audited.run_audited_events(spark, str(raw), root, str(tmp_path / "state"), files_per_batch=1)
    assert audit(spark, root) == [(ds, 3 + n, 3 + n, "success") for n, ds in enumerate(DAYS)]
    assert facts_per_day(spark, root) == [(ds, 3 + n) for n, ds in enumerate(DAYS)]
    log = spark.read.schema(audited.LOG).parquet(f"{root}/stream_log")
    batches = log.where("batch IS NOT NULL").orderBy("batch").collect()
    assert [r["rows"] for r in batches] == [3, 4, 5, 6] and [str(r["first_day"]) for r in batches] == DAYS
    assert [r["outcome"] for r in log.where("batch IS NULL").collect()] == ["complete"]
    # nothing new: nothing is added
    audited.run_audited_events(spark, str(raw), root, str(tmp_path / "state"), files_per_batch=1)
    assert len(audit(spark, root)) == 4


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_a_batch_that_loses_rows_stops_the_query(spark, tmp_path, files_per_batch):
    raw, root, state = tmp_path / "raw", str(tmp_path / "root"), str(tmp_path / "state")
    land(raw, {"2025-01-02": {"events": 9}})
    with pytest.raises(QualityError, match="2025-01-02 has 4 of 9 rows"):
        audited.run_audited_events(spark, str(raw), root, state, files_per_batch)
    lines = audit(spark, root)
    assert [x for x in lines if x[3] == "short"] == [("2025-01-02", 4, 9, "short")]
    good = facts_per_day(spark, root) if files_per_batch == 1 else []
    # the day is seen to be short when the next one begins; that batch is taken back
    assert good == ([("2025-01-01", 3), ("2025-01-02", 4)] if files_per_batch == 1 else [])
    outcomes = [r["outcome"] for r in spark.read.schema(audited.LOG).parquet(f"{root}/stream_log").where("batch IS NULL").collect()]
    assert len(outcomes) == 1 and outcomes[0].startswith("failed")
    # the manifest is put right: a restart goes on after the last good batch
    write_day(raw, "2025-01-02", manifest={"events": 4}, events=[event(k, 1, "view", f"2025-01-02 10:00:{k:02d}") for k in range(4)])
    audited.run_audited_events(spark, str(raw), root, state, files_per_batch)
    assert facts_per_day(spark, root) == [(ds, 3 + n) for n, ds in enumerate(DAYS)]
    assert {x[3] for x in audit(spark, root)} <= {"success", "short"}


def test_the_last_day_is_closed_at_the_end(spark, tmp_path):
    raw, root, state = tmp_path / "raw", str(tmp_path / "root"), str(tmp_path / "state")
    land(raw, {"2025-01-04": {"events": 7}})
    audited.run_audited_events(spark, str(raw), root, state, finish=False)
    with pytest.raises(QualityError, match="2025-01-04 has 6 of 7 rows"):
        audited.run_audited_events(spark, str(raw), root, state)


def test_more_rows_than_announced_are_allowed(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "root")
    land(raw, {"2025-01-01": {"events": 1}})
    audited.run_audited_events(spark, str(raw), root, str(tmp_path / "state"))
    assert spark.read.parquet(f"{root}/events_fact").agg(F.count("*")).first()[0] == 18
