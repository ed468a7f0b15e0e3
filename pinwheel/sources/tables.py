"""Inputs derived from the warehouse tables (parquet), used by the registered queries.

Every derivation is a plain projection or key join, so the scans read only the columns
that are used and the work grows with the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pinwheel.session import checkpoint_dir


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _transaction_base(spark: SparkSession, sf_dir: str, *line_cols: str) -> DataFrame:
    """lineitem rows with their order's customer and the customer's nation name.

    The joins start from the small dimensions (customer with nation, then orders), and the
    two large tables (lineitem, orders) meet on the order key, so lineitem is shuffled once.
    """
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag", *line_cols)
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust_nation = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    order_country = orders.join(cust_nation, orders.o_custkey == cust_nation.c_custkey)
    return li.join(order_country, li.l_orderkey == order_country.o_orderkey)


def _quantity():
    # Returned lines get a negative quantity, so the positive-quantity filter drops something.
    return F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction records (product, quantity, customer_id, country) from lineitem.

    product = part key as text; quantity = ``-l_quantity`` for returned lines; customer = the
    order's customer; country = the customer's nation name.
    """
    return _transaction_base(spark, sf_dir).select(
        F.col("l_partkey").cast("string").alias("product"),
        _quantity().alias("quantity"),
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.col("n_name").alias("country"),
    )


def transaction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records written as 8-field text lines (fields 0, 2, 4, 5 are filler)."""
    tx = _transaction_base(spark, sf_dir, "l_suppkey", "l_linenumber", "l_extendedprice")
    return tx.select(F.concat_ws(
        ",",
        F.col("l_orderkey").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        _quantity().cast("string"),
        F.col("l_suppkey").cast("string"),
        F.col("l_extendedprice").cast("string"),
        F.col("o_custkey").cast("string"),
        F.col("n_name"),
    ).alias("value"))


def _points(df: DataFrame, id_col: str, *coords) -> DataFrame:
    return df.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(id_col).cast("long").alias("ord"),
        F.array(*[c.cast("double") for c in coords]).alias("coords"),
    )


def points_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_acctbal, 100 * s_nationkey) per supplier."""
    s = load(spark, sf_dir, "supplier")
    return _points(s, "s_suppkey", F.col("s_acctbal"), F.col("s_nationkey") * 100)


def points_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_acctbal, 100 * c_nationkey) per customer."""
    c = load(spark, sf_dir, "customer")
    return _points(c, "c_custkey", F.col("c_acctbal"), F.col("c_nationkey") * 100)


def points_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_size, p_retailprice) per part; contains exact duplicates."""
    p = load(spark, sf_dir, "part")
    return _points(p, "p_partkey", F.col("p_size"), F.col("p_retailprice"))


def points_part_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p_size per part: one dimension, full of ties."""
    p = load(spark, sf_dir, "part")
    return _points(p, "p_partkey", F.col("p_size"))


def points_customer_wide(spark: SparkSession, sf_dir: str, d: int) -> DataFrame:
    """The first ``d`` of (c_acctbal, 100 * c_nationkey, c_custkey, 50 * (c_custkey mod 97)) per customer."""
    c = load(spark, sf_dir, "customer")
    coords = (F.col("c_acctbal"), F.col("c_nationkey") * 100, F.col("c_custkey"), F.col("c_custkey") % 97 * 50)
    return _points(c, "c_custkey", *coords[:d])


def points_orders_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_totalprice, 7) per order: the second dimension is constant."""
    o = load(spark, sf_dir, "orders")
    return _points(o, "o_orderkey", F.col("o_totalprice"), F.lit(7.0))


def points_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_extendedprice, l_quantity, l_discount, l_tax) per line item; id = 10 * order key + line."""
    li = load(spark, sf_dir, "lineitem").withColumn("_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return _points(li, "_id", *[F.col(c) for c in ("l_extendedprice", "l_quantity", "l_discount", "l_tax")])


def points_supplier_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(10 * s_acctbal, s_nationkey, 0, 0) per supplier, comparable with ``points_lineitem``."""
    s = load(spark, sf_dir, "supplier")
    return _points(s, "s_suppkey", F.col("s_acctbal") * 10, F.col("s_nationkey"), F.lit(0.0), F.lit(0.0))


def written_lines(lines: DataFrame, order: str | None = None) -> str:
    """Write a ``value`` column as text files into the shared checkpoint folder, sorted by
    ``order`` if given (then files in path order hold the lines in that order; the session says
    how many); their path. The folder stays until its reader deletes it."""
    path = f"{checkpoint_dir(lines.sparkSession)}/lines-{uuid.uuid4()}"
    sorted_lines = lines.repartitionByRange(order).sortWithinPartitions(order) if order else lines
    sorted_lines.select("value").write.text(path)
    return path


def points_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_totalprice, o_custkey) per order."""
    o = load(spark, sf_dir, "orders")
    return _points(o, "o_orderkey", F.col("o_totalprice"), F.col("o_custkey"))


def points_orders_skewed(spark: SparkSession, sf_dir: str, parts: int) -> DataFrame:
    """``points_orders`` with the coordinates of group 0 (``id mod parts = 0``) scaled by 0.001.

    Group 0 supplies the initial guess of the two-round solver, so shrinking it forces a
    long radius search. Every row is kept.
    """
    o = load(spark, sf_dir, "orders")
    scale = F.when(F.pmod(F.col("o_orderkey"), F.lit(parts)) == 0, F.lit(0.001)).otherwise(F.lit(1.0))
    return _points(o, "o_orderkey", F.col("o_totalprice") * scale, F.col("o_custkey").cast("double") * scale)


def points_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-dimensional embeddings cast to double, with their label."""
    e = load(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("vec_id").cast("long").alias("ord"),
        F.transform("embedding", lambda v: v.cast("double")).alias("coords"),
        F.col("label"),
    )
