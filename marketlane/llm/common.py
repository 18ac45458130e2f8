"""What the training-data operators share: tables, work folders, row identity, learning folds and Arrow slices."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlane.session import new_folder

#: Rows of one Arrow slice inside a Python task; long texts make smaller slices.
SLICE_ROWS = 512
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table of the shared folder: cut lineage that outlives any executor."""
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def every_column(df: DataFrame) -> list[Column]:
    """The columns of ``df`` under their own names, whatever marks these hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def plainly_named(df: DataFrame, *keep: str) -> DataFrame:
    """``df`` with columns named by place, all but ``keep``: ``mapInArrow`` finds none whose name holds a dot."""
    return df.toDF(*[c if c in keep else f"c{k}" for k, c in enumerate(df.columns)])


def row_key() -> Column:
    """Identity of a document row: equal ids with equal texts are one document, whatever else differs."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))


def fold(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(modulus)).cast("int")


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", rows: int | None = None, size: int | None = None
) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to a bounded number of rows and text bytes (one long text may stand alone)."""
    rows, size = rows or SLICE_ROWS, size or SLICE_BYTES
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start, held = 0, 0
        for k, n in enumerate(sizes):
            if k > start and (k - start >= rows or held + n > size):
                yield batch.slice(start, k - start)
                start, held = k, 0
            held += n
        if len(sizes) > start:
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text; missing texts are empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def to_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(n).type) for n, c in columns.items()],
        schema=pa.schema([schema.field(n) for n in columns]),
    )


class Memo(dict):
    """Dictionary that computes missing values and starts anew when it holds ``limit`` of them."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value
