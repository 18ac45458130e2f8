"""Which categories share orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lines_per_category(items: DataFrame, order: str, category: str) -> DataFrame:
    """Line count per order and category.

    Orders are dealt into as many partitions as the session shuffles into: lines sent shrink to a few bytes,
    and tasks merged by those would hold many times that as groups and baskets.
    """
    lines = items.where(F.col(category).isNotNull() & F.col(order).isNotNull()).select(order, category)
    return (
        lines.repartition(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), order)
        .groupBy(order, category)
        .agg(F.count("*").alias("n"))
    )


def category_pairs(items: DataFrame, order: str, category: str) -> DataFrame:
    """Row pairs of different categories within one order: ``cat_a < cat_b, together``.

    Pairs are formed from each order's sorted categories and summed before they
    are shuffled, so every task sends at most one row per pair of categories.
    An order has at most one entry per category of the catalogue.
    """
    baskets = (
        lines_per_category(items, order, category)
        .groupBy(order)
        .agg(F.sort_array(F.collect_list(F.struct(F.col(category).alias("cat"), "n"))).alias("basket"))
        .where(F.size("basket") > 1)
    )
    left = baskets.select("basket", F.posexplode("basket").alias("pos", "a"))
    pairs = left.select("a", F.explode(F.expr("slice(basket, pos + 2, size(basket))")).alias("b"))
    return pairs.groupBy(F.col("a.cat").alias("cat_a"), F.col("b.cat").alias("cat_b")).agg(
        F.sum(F.col("a.n") * F.col("b.n")).alias("together")
    )


def category_pairs_by_join(items: DataFrame, order: str, category: str) -> DataFrame:
    """Same result as a self-join with an equality and a ``<`` condition."""
    lines = lines_per_category(items, order, category)
    a = lines.select(order, F.col(category).alias("cat_a"), F.col("n").alias("n_a"))
    b = lines.select(F.col(order).alias("_order"), F.col(category).alias("cat_b"), F.col("n").alias("n_b"))
    on = (F.col(order) == F.col("_order")) & (F.col("cat_a") < F.col("cat_b"))
    return a.join(b, on).groupBy("cat_a", "cat_b").agg(F.sum(F.col("n_a") * F.col("n_b")).alias("together"))
