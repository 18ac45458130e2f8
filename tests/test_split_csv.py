"""The parallel CSV scan against Spark's own reader, which takes a file as one task."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from marketlane.schemas import landing_schema
from marketlane.sources import landing, split_csv

COLUMNS = landing_schema("order_items").fieldNames()
BITS = ["a", '"', ",", "\n", "\r\n", " ", "é", '""', "x" * 40, "\t", "'"]


@pytest.fixture(autouse=True)
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "50")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def write(path, rows, end="\n", encoding="utf-8"):
    with open(path, "w", newline="", encoding=encoding) as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(COLUMNS)
        out.writerows(rows)
    return str(path)


def sorted_rows(df):
    return sorted(map(repr, df.collect()))


def both(spark, path):
    whole = landing.read_csv(spark, "order_items", path, split=False)
    return sorted_rows(whole), sorted_rows(landing.read_csv(spark, "order_items", path, split=True))


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_whole_file_reader(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [[str(k)] + ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 9))) for _ in COLUMNS[1:]] for k in range(300)]
    # one record over many splits, and one that is a single line longer than a split
    rows.insert(150, ["long", "\n".join(['say "so"'] * 900), "", "", ""])
    rows.insert(200, ["wide", "y" * 3000, "", "", ""])
    path = write(tmp_path / "items.csv", rows)
    assert split_csv.lines_of(spark, [path]).rdd.getNumPartitions() >= 8
    whole, cut = both(spark, path)
    assert len(cut) == 302 and whole == cut


def test_quotes_at_every_split_edge(spark, tmp_path):
    """A quoted line break is moved byte by byte over the edges of the splits."""
    for shift in range(0, 60, 7):
        rows = [[str(k), 'a"\n"b' if k % 3 else "plain", "\n", '"', "z" * (k % 5)] for k in range(90)]
        path = write(tmp_path / f"edge{shift}.csv", [["first", "p" * shift, "", "", ""], *rows])
        whole, cut = both(spark, path)
        assert whole == cut


def test_carriage_returns_and_empty_lines(spark, tmp_path):
    rows = [["1", "a\r\nb", "", "c", "d"], ["2", "e", "\r", "f", "g"]] * 60
    whole, cut = both(spark, write(tmp_path / "crlf.csv", rows, end="\r\n"))
    assert whole == cut and len(cut) == 120
    blank = tmp_path / "blank.csv"
    blank.write_text(",".join(COLUMNS) + "\n\n1,2,3,4,5\n\n\n6,7,8,9,10")
    whole, cut = both(spark, str(blank))
    assert whole == cut and len(cut) == 2


def test_header_only_and_several_files(spark, tmp_path):
    paths = [write(tmp_path / f"f{n}.csv", [[f"{n}-{k}", "q\nr", "", "", ""] for k in range(40 * n)]) for n in range(4)]
    whole, cut = both(spark, paths)
    assert whole == cut and len(cut) == 240
    rows = split_csv.read(spark, landing_schema("order_items"), paths, landing.CSV_OPTIONS)
    counts = {r["_file"].rsplit("/", 1)[1]: r["count"] for r in rows.groupBy("_file").count().collect()}
    assert counts == {"f1.csv": 40, "f2.csv": 80, "f3.csv": 120}
    assert landing.read_csv(spark, "order_items", paths[0], split=True).count() == 0


@pytest.mark.parametrize("bad", ['1,5" disk,3,4,5', "1,2,3,4", "1,2,3,4,5,6", '1,"a"b,3,4,5'])
def test_malformed_records_fail(spark, tmp_path, bad):
    path = tmp_path / "bad.csv"
    path.write_text(",".join(COLUMNS) + "\n" + "1,2,3,4,5\n" * 50 + bad + "\n" + "1,2,3,4,5\n" * 50)
    with pytest.raises(Exception, match="quote inside an unquoted field|MALFORMED"):
        landing.read_csv(spark, "order_items", str(path), split=True).collect()


def test_large_files_are_split_and_small_ones_not(spark, tmp_path):
    large = write(tmp_path / "large.csv", [[str(k), "a\nb", "", "", ""] for k in range(500)])
    small = write(tmp_path / "small.csv", [["1", "a\nb", "", "", ""]])
    assert split_csv.worth_it(spark, [small, large]) and not split_csv.worth_it(spark, [small])
    plan = landing.read_csv(spark, "order_items", large)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" in plan and "FileScan csv" not in plan
    # no line is shuffled: exchanges carry one row per split or piece of one
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert all("file#" in line for line in exchanges)
    assert "FileScan csv" in landing.read_csv(spark, "order_items", small)._jdf.queryExecution().executedPlan().toString()


def test_day_and_entity_layouts(spark, tmp_path):
    from datetime import datetime

    days = ["2024-01-01", "2024-01-02"]
    for n, ds in enumerate(days):
        (tmp_path / "byday" / ds).mkdir(parents=True)
        write(tmp_path / "byday" / ds / "order_items.csv", [[f"{n}-{k}", "a\nb", "", "", ""] for k in range(50 + n)])
        (tmp_path / "byentity" / "orders").mkdir(parents=True, exist_ok=True)
        folder = tmp_path / "byentity" / "order_items" / f"_source_date={ds}"
        folder.mkdir(parents=True)
        write(folder / "part.csv", [[f"{n}-{k}", "a\nb", "", "", ""] for k in range(50 + n)])
    for root in ("byday", "byentity"):
        rows = landing.read_entity(spark, str(tmp_path / root), "order_items", datetime(2024, 2, 1), "b", days)
        counts = {str(r["_source_date"]): r["n"] for r in rows.groupBy("_source_date").agg(F.count("*").alias("n")).collect()}
        assert counts == {"2024-01-01": 50, "2024-01-02": 51}
        one = landing.read_entity(spark, str(tmp_path / root), "order_items", datetime(2024, 2, 1), "b", days[:1])
        assert one.count() == 50
