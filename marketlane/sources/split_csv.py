"""CSV files of any size read in parallel although quoted fields may hold newlines.

A line break ends a record if the number of quotes before it in the file is even
(quotes inside quoted fields are doubled).  So three passes at most over the splits that
Spark makes of a file are enough, and no line is shuffled:

1. every split counts its quotes; a running sum per file, over one row per split,
   tells which splits begin inside a quoted field.  This table is written when the read
   is set up;
2. every split cuts its lines into records from that start on; the piece of a record
   that began in an earlier split, and the piece that goes on in a later one, are left
   out;
3. if any split begins inside a field, those that begin or end so give these pieces, which
   are put together per record: a few rows per split.

The table of splits that each pass looks its start up in has one row per
``spark.sql.files.maxPartitionBytes`` of input: 100 TB in splits of 128 MB are 800,000
rows.  Lines are counted and joined by Arrow kernels, a batch at a time.

A quote in the middle of an unquoted field would shift the count.  It fails the read
(``malformed``), as a wrong number of fields does.  Records end with a line feed, with or
without a carriage return before it.  Empty lines are no records.  The first record of each file is its header.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from marketlane.session import new_folder, split_bytes
from marketlane.sources import storage

#: What a split gives: whole records, the end of one, the beginning of one, and a part that neither begins nor ends.
WHOLE, END, BEGIN, MIDDLE = 0, 1, 2, 3
CUT = "split long, kind int, first boolean, record string"


def lines_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file, start, bytes, value``: every line with the split that reads it, in file order within a task."""
    rows = spark.read.option("lineSep", "\n").text(list(paths))
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("bytes"),
        "value",
    )


def splits_of(lines: DataFrame) -> DataFrame:
    """``file, start, bytes, split, open, left_open``: one row per split; ``open`` if it begins inside a quoted field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    odd = lines.groupBy("file", "start", "bytes").agg((F.sum(quotes) % 2).alias("odd"))  # partial sums: a row per split leaves a task
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (F.sum("odd").over(upto) % 2).alias("ends")
    return odd.select("*", ends).select(
        "file",
        "start",
        "bytes",
        F.xxhash64("file", "start").alias("split"),
        ((F.col("ends") + F.col("odd")) % 2 == 1).alias("open"),
        (F.col("ends") == 1).alias("left_open"),
    )


def _cut(wanted: frozenset[int]):
    """Arrow function from lines of splits to those kinds of records and pieces that are wanted."""
    schema = pa.schema([("split", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("record", pa.string())])

    def rows(split, kind, first, records) -> pa.RecordBatch:
        count = len(records)
        columns = [np.full(count, split), np.full(count, kind, dtype=np.int32), np.array(first, dtype=bool)]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), records], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, inherited, inside, fresh = None, [], False, 0, False

        def leave() -> Iterator[pa.RecordBatch]:
            """The unfinished piece at the end of a split."""
            kind = MIDDLE if inherited else BEGIN
            if held and kind in wanted:
                yield rows(split, kind, [fresh], pa.array(["\n".join(held)], pa.string()))

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("split").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), batch.num_rows]
            for low, high in zip(edges, edges[1:]):
                part = batch.slice(low, high - low)
                if ids[low] != split:
                    yield from leave()
                    split, held = int(ids[low]), []
                    inside = int(part.column("open")[0].as_py())
                    inherited, fresh = bool(inside), part.column("start")[0].as_py() == 0
                value = part.column("value").cast(pa.string())
                after = (inside + np.cumsum(pc.count_substring(value, '"').to_numpy(zero_copy_only=False))) & 1
                inside = int(after[-1])
                ends = np.flatnonzero(after == 0) + 1
                if not len(ends):
                    held += value.to_pylist()
                    continue
                done = int(ends[-1])
                offsets = pa.array(np.r_[0, ends].astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, value.slice(0, done))
                joined = pc.binary_join(lists, "\n")
                if held:  # the first of them began in an earlier batch or split
                    opening = pa.array(["\n".join([*held, joined[0].as_py()])], pa.string())
                    joined, held = pa.concat_arrays([opening, joined.slice(1)]), []
                if inherited:
                    if END in wanted:
                        yield rows(split, END, [False], joined.slice(0, 1))
                    joined, inherited = joined.slice(1), False
                if len(joined) and WHOLE in wanted:
                    yield rows(split, WHOLE, [fresh] + [False] * (len(joined) - 1), joined)
                fresh = fresh and not len(joined)
                held = value.slice(done).to_pylist()
        yield from leave()

    return run


def malformed(record: Column) -> Column:
    """Whether a quote stands in the middle of an unquoted field, or text beside a quoted one."""
    pieces = F.split(record, '"', -1)
    last = F.size(pieces) - 1
    outside = F.filter(
        F.transform(pieces, lambda p, i: F.struct(p.alias("p"), i.alias("i"))), lambda x: x["i"] % 2 == 0
    )
    wrong = lambda x: ((x["i"] > 0) & (x["p"] != "") & ~x["p"].startswith(",")) | (
        (x["i"] < last) & (x["p"] != "") & ~x["p"].endswith(",")
    )
    return F.contains(record, F.lit('"')) & F.exists(outside, wrong)


def records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file, record``: all records of the files, headers and empty lines left out."""
    lines = lines_of(spark, paths)
    folder = new_folder(spark, "csv-splits")
    splits_of(lines).write.parquet(folder)
    splits = spark.read.parquet(folder)
    moved = F.raise_error(F.lit("the files were split in another way between two passes; read them again"))

    def cut(of: DataFrame, how: str, wanted: set[int]) -> DataFrame:
        placed = lines.join(F.broadcast(of), ["file", "start", "bytes"], how)
        known = F.when(F.col("split").isNull(), moved.cast("bigint")).otherwise(F.col("split")).alias("split")
        found = placed.select(known, "start", "open", "value").mapInArrow(_cut(frozenset(wanted)), CUT)
        return found.join(F.broadcast(of.select("split", "file", "start")), "split")

    whole = cut(splits, "left", {WHOLE}).select("file", "record", "first")
    if not splits.where("open OR left_open").limit(1).count():
        return _without_headers(whole)
    edge = cut(splits.where("open OR left_open"), "inner", {END, BEGIN, MIDDLE})
    place = F.struct("start", (F.col("kind") != END).alias("late"))  # the end of a record comes before the next begins
    number = F.sum((F.col("kind") == BEGIN).cast("long")).over(Window.partitionBy("file").orderBy("start", F.col("kind") != END))
    spanning = (
        edge.select("file", "first", number.alias("number"), F.struct(place.alias("place"), "record").alias("piece"))
        .groupBy("file", "number")
        .agg(F.max("first").alias("first"), F.array_sort(F.collect_list("piece")).alias("pieces"))
        .select("file", F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record"), "first")
    )
    return _without_headers(whole.unionByName(spanning))


def _without_headers(every: DataFrame) -> DataFrame:
    """Line ends of a file with carriage returns become line feeds inside its fields too, as Spark's own reader has it."""
    record = F.col("record")
    bare = F.replace(F.substring(record, F.lit(1), F.length(record) - 1), F.lit("\r\n"), F.lit("\n"))
    rows = every.where(~F.col("first")).select("file", F.when(record.endswith("\r"), bare).otherwise(record).alias("record"))
    return rows.where(record != "")


def read(spark: SparkSession, schema: T.StructType, paths: Sequence[str], options: dict[str, str]) -> DataFrame:
    """Columns of ``schema`` and ``_file``; malformed records fail the read."""
    stray = F.raise_error(F.concat(F.lit("a quote inside an unquoted field: "), F.substring("record", 1, 200)))
    checked = F.when(malformed(F.col("record")), stray.cast("string")).otherwise(F.col("record"))
    settings = {k: v for k, v in options.items() if k not in ("header", "columnPruning")} | {"multiLine": "true"}
    typed = F.from_csv(checked, schema.simpleString()[len("struct<") : -1].replace(":", " "), settings)
    return records(spark, paths).select(typed.alias("r"), F.col("file").alias("_file")).select("r.*", "_file")


def worth_it(spark: SparkSession, paths: Sequence[str]) -> bool:
    """Whether any of the files is larger than one split and can be split (compressed ones can't)."""
    most = split_bytes(spark)
    return any(size > most and not name.endswith((".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")) for name, size in storage.files(spark, paths))
