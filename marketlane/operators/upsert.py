"""Insert-or-update of dimensions by column policy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from marketlane.operators.copies import first_per_key

# Columns that a later delivery of the same key replaces; the rest keep their first value.
MUTABLE_COLUMNS = {
    "categories": [],
    "users": ["email", "full_name", "is_active"],
    "products": ["price", "rating", "is_available"],
}


def upsert_by_policy(
    versions: DataFrame, key: str, mutable: Sequence[str], arrival: str = "_source_date"
) -> DataFrame:
    """Fold all deliveries of each key into one row plus ``first_ds``.

    Mutable columns come from the latest delivery (also when it is NULL), the
    others from the first one.  Partial aggregation keeps hot keys cheap.
    """
    fixed = [c for c in versions.columns if c not in (key, arrival, *mutable)]
    newest = F.max_by(F.struct(*mutable), F.struct(arrival, *mutable)) if mutable else None
    oldest = F.min_by(F.struct(*fixed), F.struct(arrival, *fixed, *mutable))
    aggregates = [F.min(arrival).alias("first_ds"), oldest.alias("_oldest")]
    if newest is not None:
        aggregates.append(newest.alias("_newest"))
    folded = versions.groupBy(key).agg(*aggregates)
    source = {c: f"_newest.{c}" if c in mutable else f"_oldest.{c}" for c in fixed + list(mutable)}
    ordered = [c for c in versions.columns if c in source]
    return folded.select(key, *[F.col(source[c]).alias(c) for c in ordered], "first_ds")


def insert_if_absent(
    incoming: DataFrame, existing: DataFrame, key: str, order_by: Sequence[str]
) -> DataFrame:
    """Rows to add: first incoming row of each key that ``existing`` lacks."""
    return not_in(first_per_key(incoming, [key], order_by), existing, key)


def only_keys_of(known: DataFrame, rows: DataFrame, key: str, column: str | None = None) -> DataFrame:
    """Cut a long list of known keys down to those that ``rows`` can ask for."""
    asked = rows.select(F.col(column or key).alias(key)).distinct()
    return known.join(asked, key, "left_semi")


def not_in(incoming: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Anti join whose big side is first cut down to the keys that come in.

    ``existing`` is the whole history and ``incoming`` one slice: the semi join
    lets Spark broadcast or bloom-filter the slice instead of moving history.
    """
    seen = existing.select(key).join(incoming.select(key), key, "left_semi")
    return incoming.join(seen, key, "left_anti")
