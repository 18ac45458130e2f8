"""Mergeable distinct-count states and the three ways to count distinct values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from marketlane.functions.columns import as_column

# 2^12 registers, standard error about 1.6 %.
HLL_PRECISION = 12
HLL_ERROR = 1.04 / (2 ** (HLL_PRECISION / 2))


def uniq_state(c: str | Column) -> Column:
    """Aggregate: distinct-count sketch of a column."""
    return F.hll_sketch_agg(as_column(c), F.lit(HLL_PRECISION))


def uniq_merge_state(c: str | Column) -> Column:
    """Aggregate: union of sketches, still a sketch."""
    return F.hll_union_agg(as_column(c))


def uniq_merge(c: str | Column) -> Column:
    """Aggregate: estimate from the union of sketches."""
    return F.hll_sketch_estimate(F.hll_union_agg(as_column(c)))


def uniq_hll12(c: str | Column) -> Column:
    return F.hll_sketch_estimate(uniq_state(c))


def uniq_adaptive(c: str | Column, rsd: float = 0.01) -> Column:
    return F.approx_count_distinct(as_column(c), rsd)
