"""Query scans over core tables or an outside database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_query(
    spark: SparkSession, query: str, tables: Mapping[str, DataFrame], params: dict | None = None
) -> DataFrame:
    """Run a SQL text over the given frames; ``:name`` parameters are bound.

    Frames are referenced as ``{name}``, so no view outlives the call.
    """
    return spark.sql(query, args=params or {}, **tables)


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 1,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Query of an outside database, split by a numeric column when bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    if split_column and bounds:
        return (
            reader.option("dbtable", f"({query}) q")
            .option("partitionColumn", split_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", splits)
            .load()
        )
    return reader.option("query", query).load()
