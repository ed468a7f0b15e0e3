"""Product popularity: distinct customers per product, top-H or full listings.

Input: transaction records (product, quantity, customer_id, country).

Scale notes
- The (product, customer) dedup is a ``distinct``: Catalyst runs a partial aggregate in
  every task before the shuffle, so a pair repeated in a third of all rows collapses map-side.
- ``popularity_grouped`` counts distinct pairs per (product, customer-hash bucket) and sums
  the buckets after: a product bought by a third of all customers is spread over
  ``buckets`` reducers instead of one.
- Top-H is ``orderBy(...).limit(H)`` which plans as ``TakeOrderedAndProject``: every task keeps
  its own H best rows and only those reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the country parameter that disables the country filter.
ALL_COUNTRIES = "all"


def filter_transactions(tx: DataFrame, country: str = ALL_COUNTRIES) -> DataFrame:
    """Keep positive quantities (NaN is not positive) and, unless ``country == "all"``,
    the exact, case-sensitive country."""
    q = F.col("quantity")
    kept = tx.filter((q > 0) & ~F.isnan(q))
    if country != ALL_COUNTRIES:
        kept = kept.filter(F.col("country") == F.lit(country))
    return kept


def product_customer_pairs(tx: DataFrame, country: str = ALL_COUNTRIES) -> DataFrame:
    """Distinct (product, customer_id) pairs of the kept transactions."""
    return filter_transactions(tx, country).select("product", "customer_id").distinct()


def pair_count(pairs: DataFrame) -> DataFrame:
    """One row: the number of distinct pairs."""
    return pairs.agg(F.count(F.lit(1)).alias("pair_count"))


def row_count(lines: DataFrame) -> DataFrame:
    """One row: the number of input records, before any filter."""
    return lines.agg(F.count(F.lit(1)).alias("n_rows"))


def popularity_grouped(pairs: DataFrame, buckets: int = 8) -> DataFrame:
    """Two-round count over distinct (product, customer_id) pairs: partial counts per
    (product, customer-hash bucket), then their sum per product.

    Only the pair exchange carries rows; the later exchanges carry one partial count per
    task and bucket, and a product bought by a third of all customers is split over
    ``buckets`` reducers. Taking the same distinct pairs as ``popularity_reduced`` lets a
    plan that needs both share their exchange.
    """
    bucket = F.pmod(F.xxhash64("customer_id"), F.lit(buckets))
    partial = pairs.groupBy("product", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return partial.groupBy("product").agg(F.sum("n").cast("long").alias("popularity"))


def popularity_reduced(pairs: DataFrame) -> DataFrame:
    """Direct count of pairs per product (the map-side combine is Catalyst's partial count)."""
    return pairs.groupBy("product").agg(F.count(F.lit(1)).alias("popularity"))


def top_popular(popularity: DataFrame, h: int) -> DataFrame:
    """The H most popular products; equal popularities are ordered by product."""
    if h <= 0:
        raise ValueError("h must be positive for a top-H listing")
    return popularity.orderBy(F.desc("popularity"), F.asc("product")).limit(h)


def sorted_popularities(pop1: DataFrame, pop2: DataFrame) -> DataFrame:
    """Both full listings, one ``variant`` column apart, ordered by variant then product."""
    both = pop1.select(F.lit(1).alias("variant"), "product", "popularity").unionByName(
        pop2.select(F.lit(2).alias("variant"), "product", "popularity"))
    return both.orderBy("variant", "product")


def popularity_report(tx: DataFrame, h: int, country: str = ALL_COUNTRIES, buckets: int = 8) -> DataFrame:
    """The report: the top-H when ``h > 0``, else both full listings.

    For the top-H the direct count is enough: its partial counts already keep a hot product
    from travelling row by row.

    One schema for both: (variant, product, popularity), already in listing order. The full
    listing is a global sort (range-partitioned), never a single-task window.
    """
    pairs = product_customer_pairs(tx, country)
    if h > 0:
        return top_popular(popularity_reduced(pairs), h).select(
            F.lit(1).alias("variant"), "product", "popularity")
    # Both listings start from the same distinct pairs, so the exchange that produces them is
    # planned once and reused: the transaction joins run once.
    return sorted_popularities(popularity_grouped(pairs, buckets), popularity_reduced(pairs))
