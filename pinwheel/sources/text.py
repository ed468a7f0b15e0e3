"""Text sources: transaction lines and point lines.

Transaction line (comma-separated, no header, at least 8 fields): field 1 product,
field 3 quantity, field 6 customer id, field 7 country; the others are never read.
Point line: comma-separated doubles, one point per line, no id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pinwheel.functions.parse import is_int, split_fields, to_vector
from pinwheel.session import checkpoint_dir

# Positions of the fields that are read from a transaction line.
PRODUCT_FIELD = 1
QUANTITY_FIELD = 3
CUSTOMER_FIELD = 6
COUNTRY_FIELD = 7

TRANSACTION_SCHEMA = T.StructType([
    T.StructField("product", T.StringType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("country", T.StringType()),
])


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Raw lines as a ``value`` column. ``partitions`` redistributes them round-robin.

    File splits are already read in parallel, so redistributing is only worth its shuffle
    when the input is a few large unsplittable files.
    """
    lines = spark.read.text(path)
    return lines.repartition(partitions) if partitions else lines


def parse_transactions(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parse transaction lines into (product, quantity, customer_id, country).

    One malformed line fails the job, whichever of its columns a query goes on to use and
    whichever rows it filters: every column is a CASE on the validity of the whole line, so
    neither column pruning nor a filter pushed below another column can skip the test. The
    columns come out of a generator of one row: a filter pushed below it would split the line
    anew for each of its mentions of a token.
    """
    tokens = F.col("_t")
    quantity = F.get(tokens, QUANTITY_FIELD).try_cast("double")
    customer = F.get(tokens, CUSTOMER_FIELD)
    valid = (F.size(tokens) > max(PRODUCT_FIELD, QUANTITY_FIELD, CUSTOMER_FIELD, COUNTRY_FIELD)) \
        & quantity.isNotNull() & is_int(customer)
    message = F.concat(F.lit("malformed transaction line: "), F.coalesce(F.concat_ws(",", tokens), F.lit("null")))

    def checked(column, name, kind):
        return F.when(valid, column).otherwise(F.raise_error(message).cast(kind)).alias(name)

    return lines.select(split_fields(value).alias("_t")).select(F.inline(F.array(F.struct(
        checked(F.get(tokens, PRODUCT_FIELD), "product", "string"),
        checked(quantity, "quantity", "double"),
        checked(customer.try_cast("int"), "customer_id", "int"),
        checked(F.get(tokens, COUNTRY_FIELD), "country", "string"),
    ))))


def read_transactions(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    return parse_transactions(read_lines(spark, path, partitions))


def parse_points(lines: DataFrame, value: str = "value") -> DataFrame:
    """Replace the text column by ``coords array<double>``; other columns are kept."""
    return lines.withColumn("coords", to_vector(value)).drop(value)


# Split tables up to this many rows (one per file split) are broadcast to number the lines.
BROADCAST_SPLITS = 500_000


def read_points(spark: SparkSession, path: str, broadcast_splits: int = BROADCAST_SPLITS) -> DataFrame:
    """Point lines as (id, ord, coords), where ``id = ord`` is the line's position in the input
    (files in path order, lines in file order, numbered from 0).

    "First point" and first-wins ties are part of the questions, so the input order has to
    survive as a column. The lines are read once and written to the shared checkpoint folder
    with their split (file, start offset) and a number that grows along each task; both the
    lines per split and the lines themselves come from those written rows, so however the
    files would be split in another run, no line can miss its split. Prefix sums over the
    splits in file order give each split's first line number. The text never leaves the JVM,
    and only a split table too large to broadcast makes it shuffle.
    """
    checkpoint_dir(spark)
    raw = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_mid")).checkpoint()
    splits = raw.groupBy("_file", "_start").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_file", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")).checkpoint()
    few = offsets.count() <= broadcast_splits
    numbered = raw.join(F.broadcast(offsets) if few else offsets, ["_file", "_start"]).select(
        (F.col("_offset") + F.col("_mid") - F.col("_first")).alias("id"), "value")
    return parse_points(numbered).select("id", F.col("id").alias("ord"), "coords")
