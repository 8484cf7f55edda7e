"""Observed category co-affinity of baskets.

No pairs of a basket's categories are ever formed.  Baskets are reduced to
their sets of categories and equal sets counted once, so what remains grows
with the number of different sets.  Each set then gives one row per member
(linear), and a category's row adds up, for every category, the baskets whose
set holds both: a mergeable row of as many counters as the catalogue has
categories, summed on both sides of the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Related categories by declaration.
CATEGORY_AFFINITY = {
    "Snacks": ["Beverages", "Breakfast Foods"],
    "Beverages": ["Snacks"],
    "Dairy & Eggs": ["Bakery", "Breakfast Foods"],
    "Fresh Produce": ["Meat & Seafood", "Pantry Staples"],
    "Pantry Staples": ["Canned Goods", "Rice & Noodles"],
    "Rice & Noodles": ["Canned Goods", "Pantry Staples"],
    "Cleaning Supplies": ["Household Essentials"],
    "Household Essentials": ["Cleaning Supplies"],
    "Personal Care": ["Health & Beauty"],
    "Health & Beauty": ["Personal Care"],
}
#: More counters than this don't fit a row; group categories to departments first.
MOST_CATEGORIES = 2000


def category_sets(lines: DataFrame, basket: str = "transaction_id", category: str = "category") -> DataFrame:
    """Different sets of categories with the number of baskets that have them: categories, baskets."""
    sets = (lines.where(F.col(category).isNotNull() & F.col(basket).isNotNull())
            .groupBy(basket).agg(F.array_sort(F.collect_set(category)).alias("categories")))  # at most one of each category
    return sets.groupBy("categories").agg(F.count(F.lit(1)).alias("baskets"))


def co_affinity(lines: DataFrame, basket: str = "transaction_id", category: str = "category", top: int = 3,
                least: int = 1) -> DataFrame:
    """Per category its ``top`` neighbours by common baskets (ties: by name), from ``least`` baskets on.

    -> (category, neighbour, baskets, share, rank); share is of the category's
    own baskets.  Null categories and baskets are left out.
    """
    sets = category_sets(lines, basket, category)
    names = [r[0] for r in lines.select(category).where(F.col(category).isNotNull()).distinct().orderBy(category)
             .limit(MOST_CATEGORIES + 1).collect()]  # the catalogue's categories, not baskets
    if len(names) > MOST_CATEGORIES:
        raise ValueError(f"more than {MOST_CATEGORIES} categories")
    empty = lines.sparkSession.createDataFrame([], "category string, neighbour string, baskets long, share double, rank int")
    if not names:
        return empty
    member = sets.select(F.explode("categories").alias("category"), "categories", "baskets")
    counted = member.groupBy("category").agg(F.sum("baskets").alias("__own"), *[
        F.sum(F.when(F.array_contains("categories", n), F.col("baskets")).otherwise(0)).alias(f"__n{i}") for i, n in enumerate(names)])
    pairs = counted.select("category", "__own", F.inline(F.array(*[
        F.struct(F.lit(n).alias("neighbour"), F.col(f"__n{i}").alias("baskets")) for i, n in enumerate(names)])))
    rank = Window.partitionBy("category").orderBy(F.desc("baskets"), "neighbour")  # at most one row a category
    return (pairs.where((F.col("category") != F.col("neighbour")) & (F.col("baskets") >= least))
            .select("category", "neighbour", "baskets", F.round(F.col("baskets") / F.col("__own"), 6).alias("share"),
                    F.row_number().over(rank).alias("rank")).where(F.col("rank") <= top))


def basket_focus(lines: DataFrame, neighbours: DataFrame, basket: str = "transaction_id", category: str = "category",
                 order: str = "product_id") -> DataFrame:
    """How much of a basket lies in its seed category and that category's neighbours.

    The seed is the category of the basket's first line in ``order``.
    -> (basket, seed, lines, inside, share).
    """
    own = lines.where(F.col(category).isNotNull())
    seeds = own.groupBy(F.col(basket).alias("__b")).agg(F.min(F.struct(F.col(order), F.col(category).alias("c")))["c"].alias("seed"))
    related = neighbours.select(F.col("category").alias("seed"), F.col("neighbour").alias("__near")).unionByName(
        neighbours.select(F.col("category").alias("seed"), F.col("category").alias("__near"))).distinct()
    met = (own.join(seeds, F.col(basket) == F.col("__b")).withColumn("__near", F.col(category))
           .join(related.withColumn("__in", F.lit(1)), ["seed", "__near"], "left"))
    inside = F.coalesce(F.sum(F.when((F.col("__in") == 1) | (F.col("__near") == F.col("seed")), 1).otherwise(0)), F.lit(0))
    return (met.groupBy(basket, "seed").agg(F.count(F.lit(1)).alias("lines"), inside.alias("inside"))
            .select(basket, "seed", "lines", "inside", F.round(F.col("inside") / F.col("lines"), 6).alias("share")))
