"""Size-balanced shards by sampled splitters, with DataFrame functions only.

Rows are ordered by text digest and id, so equal texts lie next to each other
without a group ever having to fit one range.  Splitters are keys drawn with a
chance in proportion to size; they cut the order into ranges, and ranges that
turn out overfull draw splitters of their own until none is left.  Running sums
inside the ranges, on top of the totals of earlier ranges, give every row its
exact place by bytes: sampling decides how the work is cut, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlane.llm.common import written

SHARDS = 16
#: Ranges per shuffle partition.
RANGES_PER_PARTITION = 4
#: Splitters are literals of the plan, so there are at most so many to begin with; sorting inside ranges can spill.
MOST_RANGES = 2048
#: Draws for each splitter that is wanted.
OVERSAMPLING = 8
#: A range of more than this many times its share is cut again.
OVERFULL = 3.0


def sized(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.md5(text).alias("digest"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )


def _rank() -> Column:
    return F.struct("digest", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"))


def _range_of(splitters: list[tuple[str, int]]) -> Column:
    """Number of splitters at or below a row's rank, by halving steps over a literal array."""
    if not splitters:
        return F.lit(0)
    bounds = F.array(*[F.struct(F.lit(d).alias("digest"), F.lit(i).cast("long").alias("id")) for d, i in splitters])
    steps, step = [], 1
    while step <= len(splitters):
        steps.insert(0, step)
        step *= 2

    def halve(low: Column, step: Column) -> Column:
        inside = low + step <= F.lit(len(splitters))
        passed = F.when(inside, F.element_at(bounds, F.least(low + step, F.lit(len(splitters)))) <= _rank()).otherwise(False)
        return F.when(passed, low + step).otherwise(low)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), halve)


def _draw(rows: DataFrame, weight: Column, wanted: float, seed: int) -> list[tuple[str, int]]:
    """Splitters at the quantiles of about ``wanted * OVERSAMPLING`` keys drawn in proportion to ``weight`` (summing to 1)."""
    chance = F.pmod(F.xxhash64("digest", "doc_id", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    drawn = rows.where(chance < weight * float(wanted * OVERSAMPLING)).select(_rank().alias("r")).distinct().collect()
    keys = sorted((r["r"]["digest"], r["r"]["id"]) for r in drawn)
    return keys[OVERSAMPLING // 2 :: OVERSAMPLING] or keys[:1]


def splitters(rows: DataFrame, ranges: int) -> tuple[list[tuple[str, int]], int, int]:
    """Keys that cut ``rows`` into about ``ranges`` ranges, none overfull in bytes or rows; total bytes and rows."""
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    if not total["n"]:
        return [], 0, 0
    # half by size, half by row, so that a crowd of tiny documents also gets its splitters
    weight = F.col("size") / float(2 * total["b"]) + F.lit(1.0 / (2 * total["n"]))
    found = _draw(rows, weight, ranges, 1)
    most = OVERFULL / ranges
    for seed in range(2, 12):
        by_range = rows.groupBy(_range_of(found).alias("range")).agg(
            F.sum(weight).alias("share"), F.min(_rank()).alias("low"), F.max(_rank()).alias("high")
        )
        overfull = [r for r in by_range.where((F.col("share") > most) & (F.col("low") < F.col("high"))).collect()]
        if not overfull:
            break
        more = set()
        for r in overfull:
            inside = rows.where(_range_of(found) == r["range"])
            more.update(_draw(inside, weight / r["share"], max(2.0, r["share"] * ranges * 2), seed))
        if more <= set(found):
            break
        found = sorted(more | set(found))
    return found, total["b"], total["n"]


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, ranges: int | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``docs`` (``doc_id, text``).

    ``size`` is the UTF-8 length plus one (missing text: none).  Rows in order of
    text digest and id go to the shard in which the middle of their bytes falls,
    so shards differ by about one document and equal texts are together unless a
    shard ends among them.  Slots are gapless from 0 in that order.  The law is
    ``bytes``; ``grown_shard`` is missing.  Repeated rows take places of their
    own; rows without an id come first among equal texts; further columns are
    ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ranges = ranges or min(MOST_RANGES, RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = written(sized(docs), "sharding-sizes")
    found, total, _ = splitters(rows, ranges)
    ranged = rows.withColumn("range", _range_of(found))
    inside = Window.partitionBy("range").orderBy("digest", F.col("doc_id").asc_nulls_first(), "size")
    summed = ranged.select(
        "*",
        F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("bytes_to"),
        F.row_number().over(inside).cast("long").alias("row_to"),
    )
    totals = written(ranged.groupBy("range").agg(F.sum("size").alias("b"), F.count("*").alias("n")), "sharding-ranges").collect()
    before, b, n = {}, 0, 0
    for r in sorted(totals, key=lambda r: r["range"]):
        before[r["range"]] = (b, n)
        b, n = b + r["b"], n + r["n"]
    starts = F.array(*[F.struct(F.lit(x).cast("long").alias("b"), F.lit(y).cast("long").alias("n")) for x, y in _dense(before, len(found))])
    start = F.element_at(starts, F.col("range") + 1)
    # twice the middle of the row's bytes, times shards, over twice the total
    middle = (2 * (start.b + F.col("bytes_to")) - F.col("size")).cast("decimal(38,0)")
    shard = F.least(F.floor(middle * shards / F.lit(max(1, 2 * total))).cast("int"), F.lit(shards - 1))
    placed = written(
        summed.select("doc_id", "size", "text_crc32", shard.alias("shard"), (start.n + F.col("row_to") - 1).alias("place")), "sharding"
    )
    first = {r["shard"]: r["first"] for r in placed.groupBy("shard").agg(F.min("place").alias("first")).collect()}
    firsts = F.array(*[F.lit(first.get(k, 0)).cast("long") for k in range(shards)])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.element_at(firsts, F.col("shard") + 1)).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _dense(before: dict, last: int) -> list[tuple[int, int]]:
    out, held = [], (0, 0)
    for k in range(last + 1):
        held = before.get(k, held)
        out.append(held)
    return out
