import zlib

import pytest

from marketlane.llm import sharding
from tests.llm.frames import ODD, documents


def check(rows, want, shards=16):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in want
    )
    sizes = [0] * shards
    for k in range(shards):
        own = [r for r in rows if r["shard"] == k]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        sizes[k] = sum(r["size"] for r in own)
    assert all(r["law"] == "bytes" and r["grown_shard"] is None for r in rows)
    return sizes


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_shards_are_near_equal_also_with_a_hot_group(spark, ranges):
    rows = [(k, f"text number {k} " * (k % 9 + 1)) for k in range(600)] + [(k, "the same text") for k in range(600, 1000)]
    rows += [(k, "") for k in range(1000, 1300)]
    found = sharding.shard_by_bytes(documents(spark, rows), ranges=ranges).collect()
    sizes = check(found, rows)
    assert max(sizes) - min(sizes) <= 2 * max(len(t) + 1 for _, t in rows)


def test_overfull_ranges_are_subdivided(spark):
    rows = [(k, "hot") for k in range(3000)] + [(k, f"text {k}") for k in range(3000, 4000)]
    sized = sharding.sized(documents(spark, rows))
    found, _, _ = sharding.splitters(sized, 32)
    counts = [r["count"] for r in sized.groupBy(sharding._range_of(found).alias("r")).count().collect()]
    assert max(counts) < 4 * sharding.OVERFULL * len(rows) / 32


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    check(sharding.shard_by_bytes(docs).collect(), ODD)
    assert sharding.shard_by_bytes(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = sharding.shard_by_bytes(documents(spark, ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
