"""Constraint checks, load audit and the gates that stop a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


class QualityError(RuntimeError):
    """A gate found rows that must not exist."""


@dataclass(frozen=True)
class TableRules:
    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    checks: Mapping[str, str] = field(default_factory=dict)
    # column -> (parent table, parent key)
    foreign: Mapping[str, tuple[str, str]] = field(default_factory=dict)


CORE_RULES: dict[str, TableRules] = {
    "categories": TableRules(
        unique=["category_id"], not_null=["name"],
        foreign={"parent_id": ("categories", "category_id")},
    ),
    "users": TableRules(unique=["user_id"], not_null=["email", "registration_date"]),
    "products": TableRules(
        unique=["product_id"], checks={"price": "price >= 0"},
        foreign={"category_id": ("categories", "category_id")},
    ),
    "orders": TableRules(
        unique=["order_id"], not_null=["user_id", "created_at"],
        checks={"total_amount": "total_amount >= 0"},
        foreign={"user_id": ("users", "user_id")},
    ),
    "order_items": TableRules(
        unique=["order_item_id"], not_null=["order_id", "product_id", "quantity", "unit_price"],
        checks={"quantity": "quantity > 0", "unit_price": "unit_price >= 0"},
        foreign={"order_id": ("orders", "order_id"), "product_id": ("products", "product_id")},
    ),
    "payments": TableRules(
        unique=["payment_id", "order_id"], not_null=["order_id"],
        foreign={"order_id": ("orders", "order_id")},
    ),
}

REPORT = ["source_table", "rule", "column_name", "violations"]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _line(table: str, rule: str, column: str, violations: Column) -> list[Column]:
    return [
        F.lit(table).alias("source_table"),
        F.lit(rule).alias("rule"),
        F.lit(column).alias("column_name"),
        F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"),
    ]


def row_rule_report(table: str, rows: DataFrame, rules: TableRules) -> DataFrame | None:
    """NOT NULL and CHECK violations of one table in one scan."""
    # A key column may not be NULL either.
    required = list(dict.fromkeys([*rules.unique[:1], *rules.not_null]))
    lines = [("not_null", c, F.col(c).isNull()) for c in required]
    lines += [("check", c, ~F.expr(text)) for c, text in rules.checks.items()]
    counted = rows.agg(
        *[F.count_if(bad).alias(f"v{i}") for i, (_, _, bad) in enumerate(lines)]
    )
    unpivot = ", ".join(f"'{rule}', '{c}', v{i}" for i, (rule, c, _) in enumerate(lines))
    return counted.select(
        F.lit(table).alias("source_table"),
        F.expr(f"stack({len(lines)}, {unpivot}) as (rule, column_name, violations)"),
    )


def enforce_rows(table: str, rows: DataFrame, rules: Mapping[str, TableRules] = CORE_RULES) -> DataFrame:
    """The same rows; reading one that breaks a NOT NULL or CHECK rule fails the job.

    Put in front of a write, so nothing of a bad slice is committed.
    """
    rule = rules[table]
    broken = [(f"{c} is null", F.col(c).isNull()) for c in dict.fromkeys([*rule.unique[:1], *rule.not_null])]
    broken += [(f"not ({text})", ~F.expr(text)) for text in rule.checks.values()]
    verdict = F.lit(True)
    for reason, bad in broken:
        stop = F.raise_error(F.lit(f"{table}: {reason}")).cast("boolean")
        verdict = F.when(F.coalesce(bad, F.lit(False)), stop).otherwise(verdict)
    return rows.where(verdict)


def unique_report(table: str, rows: DataFrame, column: str) -> DataFrame:
    """How many key values occur more than once."""
    groups = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return groups.agg(F.count_if(F.col("n") > 1).alias("v")).select(
        *_line(table, "unique", column, F.col("v"))
    )


def _orphans(rows: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """Number of rows whose ``column`` has no parent, as one ``violations`` value.

    Children are counted per key first, so a hot key is one row in the join.
    """
    children = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_fk"))
    keys = parents.select(F.col(key).alias("_fk"))
    missing = children.agg(F.count("*").alias("_n")).join(keys, "_fk", "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"))


def foreign_report(table: str, rows: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """How many rows point at a parent that does not exist."""
    return _orphans(rows, column, parents, key).select(
        *_line(table, "foreign_key", column, F.col("violations"))
    )


def constraint_report(
    tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules] = CORE_RULES
) -> DataFrame:
    """One line per constraint with its number of violations."""
    parts: list[DataFrame] = []
    for table, rule in rules.items():
        if table not in tables:
            continue
        rows = tables[table]
        parts.append(row_rule_report(table, rows, rule))
        parts += [unique_report(table, rows, c) for c in rule.unique]
        parts += [
            foreign_report(table, rows, c, tables[parent], key)
            for c, (parent, key) in rule.foreign.items()
            if parent in tables
        ]
    return union_all(parts).select(*REPORT)


def integrity_counts(
    orders: DataFrame, order_items: DataFrame, products: DataFrame
) -> DataFrame:
    """Gate 1 as one row of four counts, all of which must be zero."""
    counts = {
        "orphan_order_items": _orphans(order_items, "order_id", orders, "order_id"),
        "orphan_product_items": _orphans(order_items, "product_id", products, "product_id"),
        "nonpositive_qty": order_items.agg(F.count_if(F.col("quantity") <= 0).alias("violations")),
        "null_user_orders": orders.agg(F.count_if(F.col("user_id").isNull()).alias("violations")),
    }
    lines = union_all([f.select(F.lit(name).alias("check"), "violations") for name, f in counts.items()])
    return lines.agg(
        *[F.sum(F.when(F.col("check") == name, F.col("violations"))).alias(name) for name in counts]
    )


def require_zero(report: DataFrame) -> None:
    """Raise when any line reports violations; the report has one line per rule."""
    bad = report.where(F.col("violations") > 0).collect()
    if bad:
        raise QualityError("; ".join(f"{r.source_table}.{r.column_name} {r.rule}: {r.violations}" for r in bad))


def require_integrity(counts: DataFrame) -> None:
    row = counts.first().asDict()
    if any(row.values()):
        raise QualityError(f"core is not consistent: {row}")


def shortfalls(staged: DataFrame, manifest: DataFrame) -> DataFrame:
    """Gate 2: entities of a day that landed with fewer rows than announced."""
    keys = ["source_date", "source_table"]
    landed = F.coalesce(F.col("rows_staging"), F.lit(0))
    return (
        manifest.join(staged.select(*keys, "rows_staging"), keys, "left")
        .where(landed < F.col("rows_manifest"))
        .select(*keys, landed.alias("rows_staging"), "rows_manifest")
    )


def require_complete(staged: DataFrame, manifest: DataFrame, path: str) -> None:
    """Raise when rows were lost; every shortfall of the run is written to ``path``."""
    bad = shortfalls(staged, manifest)
    bad.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    count = bad.sparkSession.read.schema(bad.schema).parquet(path).count()
    if count:
        raise QualityError(f"rows lost: {count} days and tables landed fewer rows than announced, see {path}")


def promotion_counts(judged: DataFrame, accepted: DataFrame, table: str) -> DataFrame:
    """Staged, rejected and promoted rows per day of one table.

    ``judged`` is the landing frame with ``reject_reason``, ``accepted`` what went to core.
    """
    day = F.col("_source_date").alias("source_date")
    staged = judged.groupBy(day).agg(
        F.count("*").alias("rows_staging"),
        F.count("reject_reason").alias("rows_rejected"),
    )
    promoted = accepted.groupBy(day).agg(F.count("*").alias("rows_promoted"))
    return staged.join(promoted, "source_date", "left").select(
        "source_date", F.lit(table).alias("source_table"), "rows_staging",
        F.coalesce("rows_promoted", F.lit(0)).alias("rows_promoted"), "rows_rejected",
    )


def load_audit(counts: DataFrame, manifest: DataFrame | None = None, expected: DataFrame | None = None) -> DataFrame:
    """Passport of every day and table.

    Staged rows that are neither promoted nor rejected lost a key conflict.
    ``expected`` lists the days and tables that were asked for; those without
    rows get a line of zeros.
    """
    keys = ["source_date", "source_table"]
    if expected is not None:
        zeros = {c: 0 for c in ("rows_staging", "rows_promoted", "rows_rejected")}
        counts = expected.select(*keys).join(counts, keys, "left").fillna(zeros)
    if manifest is None:
        joined = counts.withColumn("rows_manifest", F.lit(None).cast("bigint"))
    else:
        joined = counts.join(manifest, keys, "left")
    skipped = F.col("rows_staging") - F.col("rows_promoted") - F.col("rows_rejected")
    return joined.select(
        *keys, "rows_staging", "rows_promoted", "rows_rejected",
        skipped.alias("rows_conflict_skipped"), "rows_manifest",
    )


def reject_summary(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("source_table", "source_date", "reason").agg(F.count("*").alias("rows_rejected"))
