import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pinwheel.operators import popularity as pop
from pinwheel.sources import tables
from pinwheel.sources.text import TRANSACTION_SCHEMA, parse_transactions


def _tx(spark, rows):
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA)


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_duplicate_pairs_collapse(spark):
    tx = _tx(spark, [("p1", 1.0, 7, "France"), ("p1", 2.0, 7, "France"), ("p2", 1.0, 7, "Italy")])
    assert pop.product_customer_pairs(tx).count() == 2


def test_quantity_filter_and_nan(spark):
    tx = _tx(spark, [("a", -1.0, 1, "X"), ("b", 0.0, 1, "X"), ("c", 0.5, 1, "X"), ("d", float("nan"), 1, "X")])
    assert [r["product"] for r in pop.filter_transactions(tx).collect()] == ["c"]


def test_country_exact_and_all(spark):
    tx = _tx(spark, [("a", 1.0, 1, "France"), ("b", 1.0, 2, "france"), ("c", 1.0, 3, "all")])
    assert [r["product"] for r in pop.filter_transactions(tx, "France").collect()] == ["a"]
    assert pop.filter_transactions(tx, "all").count() == 3


def test_parse_errors(spark):
    with pytest.raises(Exception):
        parse_transactions(_lines(spark, ["0,p,2,1.0,4,5,6"])).collect()
    with pytest.raises(Exception):
        parse_transactions(_lines(spark, ["0,p,2,1.0,4,5,x,FR"])).collect()
    with pytest.raises(Exception):
        parse_transactions(_lines(spark, ["0,p,2,1.0,4,5, 7,FR"])).collect()
    row = parse_transactions(_lines(spark, ["0,p,2,1.5,4,5,+7,FR"])).collect()[0]
    assert (row["product"], row["quantity"], row["customer_id"], row["country"]) == ("p", 1.5, 7, "FR")


@pytest.mark.parametrize("bad", ["0,p,2,-1.0,4,5,x,FR", "0,p,2,1.0,4,5,6", "0,p,2,y,4,5,6,IT", "0,p,2,0,4,5, 6,IT", ""])
def test_one_bad_line_fails_every_query(spark, bad):
    """Pruned columns and filters that would drop the line don't hide it."""
    tx = parse_transactions(_lines(spark, ["0,p,2,1.0,4,5,6,FR"] * 50 + [bad]))
    for country in (pop.ALL_COUNTRIES, "FR"):
        pairs = pop.product_customer_pairs(tx, country)
        for out in (pairs, pop.pair_count(pairs), pop.top_popular(pop.popularity_reduced(pairs), 3), pop.popularity_grouped(pairs)):
            with pytest.raises(Exception, match="malformed transaction line"):
                out.collect()


def test_top_h_ties_and_order(spark):
    tx = _tx(spark, [("9", 1.0, 1, "X"), ("10", 1.0, 2, "X"), ("8", 1.0, 3, "X"), ("8", 1.0, 4, "X")])
    pairs = pop.product_customer_pairs(tx)
    top = [r["product"] for r in pop.top_popular(pop.popularity_grouped(pairs), 2).collect()]
    assert top == ["8", "10"]
    listing = [r["product"] for r in pop.sorted_popularities(pop.popularity_grouped(pairs),
                                                             pop.popularity_reduced(pairs)).collect()]
    assert listing == ["10", "8", "9", "10", "8", "9"]


def test_report_full_listing_when_h_not_positive(spark):
    tx = _tx(spark, [("a", 1.0, 1, "X"), ("b", 1.0, 1, "X")])
    assert pop.popularity_report(tx, 0).count() == 4
    assert pop.popularity_report(tx, 100).count() == 2


def test_grouped_equals_reduced(spark):
    pairs = pop.product_customer_pairs(tables.transactions(spark, SF_SMALL))
    a = {(r["product"], r["popularity"]) for r in pop.popularity_grouped(pairs, 5).collect()}
    b = {(r["product"], r["popularity"]) for r in pop.popularity_reduced(pairs).collect()}
    assert a == b


def test_partition_independence(spark):
    pairs = pop.product_customer_pairs(tables.transactions(spark, SF_SMALL))
    results = []
    for n in (1, 4, 13):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        results.append([tuple(r) for r in pop.top_popular(pop.popularity_grouped(pairs), 10).collect()])
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]


def test_parse_errors_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            parse_transactions(_lines(spark, ["0,p,2,abc,4,5,6,FR"])).collect()
        with pytest.raises(Exception):
            parse_transactions(_lines(spark, ["0,p,2,1.0,4,5,99999999999,FR"])).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_hot_product_counts(spark):
    # One product bought by a third of all transactions, with many repeats of each pair.
    rows = [("hot", 1.0, i % 500, "X") for i in range(3000)]
    rows += [(f"p{i % 97}", 1.0, i % 311, "X") for i in range(6000)]
    tx = _tx(spark, rows)
    grouped = {r["product"]: r["popularity"] for r in pop.popularity_grouped(pop.product_customer_pairs(tx), 8).collect()}
    reduced = {r["product"]: r["popularity"] for r in pop.popularity_reduced(pop.product_customer_pairs(tx)).collect()}
    want = tx.groupBy("product").agg(F.countDistinct("customer_id").alias("n")).collect()
    assert grouped == reduced == {r["product"]: r["n"] for r in want}
    assert grouped["hot"] == 500
