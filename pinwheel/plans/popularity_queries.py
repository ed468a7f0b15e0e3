"""Registered popularity queries over the warehouse tables, with their SQL oracles."""

from __future__ import annotations

from pinwheel.operators import popularity as pop
from pinwheel.sources import tables
from pinwheel.sources.text import parse_transactions, read_lines, read_transactions

# Parameters of the registered queries.
COUNTRY = "NATION_2"
REPORT_COUNTRY = "NATION_1"
TOP_H = 10
REPORT_H = 5
BUCKETS = 8

TX_SQL = """
WITH tx AS (
  SELECT CAST(l.l_partkey AS VARCHAR) AS product,
         CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS quantity,
         CAST(o.o_custkey AS INTEGER) AS customer_id,
         n.n_name AS country
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey),
kept AS (SELECT * FROM tx WHERE quantity > 0 AND NOT isnan(quantity))
"""


def _pairs(spark, sf_dir, country=pop.ALL_COUNTRIES):
    return pop.product_customer_pairs(tables.transactions(spark, sf_dir), country)


def q_tx_row_count(spark, sf_dir):
    return pop.row_count(tables.transaction_lines(spark, sf_dir))


def q_tx_parse_lines(spark, sf_dir):
    return parse_transactions(tables.transaction_lines(spark, sf_dir))


def q_tx_filter_all(spark, sf_dir):
    return pop.filter_transactions(parse_transactions(tables.transaction_lines(spark, sf_dir)))


def q_tx_filter_country(spark, sf_dir):
    return pop.filter_transactions(parse_transactions(tables.transaction_lines(spark, sf_dir)), COUNTRY)


def q_tx_pairs_all(spark, sf_dir):
    return _pairs(spark, sf_dir)


def q_tx_pairs_country(spark, sf_dir):
    return _pairs(spark, sf_dir, COUNTRY)


def q_tx_pair_count(spark, sf_dir):
    return pop.pair_count(_pairs(spark, sf_dir))


def q_popularity_grouped(spark, sf_dir):
    return pop.popularity_grouped(_pairs(spark, sf_dir), BUCKETS)


def q_popularity_reduced(spark, sf_dir):
    return pop.popularity_reduced(_pairs(spark, sf_dir))


def q_popularity_top_h(spark, sf_dir):
    return pop.top_popular(pop.popularity_reduced(_pairs(spark, sf_dir)), TOP_H)


def q_popularity_sorted(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    return pop.sorted_popularities(pop.popularity_grouped(pairs, BUCKETS), pop.popularity_reduced(pairs))


def q_popularity_report(spark, sf_dir):
    return pop.popularity_report(tables.transactions(spark, sf_dir), REPORT_H, REPORT_COUNTRY, BUCKETS)


def q_popularity_report_all(spark, sf_dir):
    """The report without a top size: both full listings."""
    return pop.popularity_report(tables.transactions(spark, sf_dir), 0, REPORT_COUNTRY, BUCKETS)


def q_tx_file_row_count(spark, sf_dir):
    """Lines of transaction files."""
    return pop.row_count(read_lines(spark, tables.written_lines(tables.transaction_lines(spark, sf_dir))))


def q_tx_file_pairs(spark, sf_dir):
    """Distinct pairs of transactions read from files."""
    tx = read_transactions(spark, tables.written_lines(tables.transaction_lines(spark, sf_dir)))
    return pop.product_customer_pairs(tx, COUNTRY)


QUERIES = {
    "popularity_report_all": q_popularity_report_all,
    "tx_file_row_count": q_tx_file_row_count,
    "tx_file_pairs": q_tx_file_pairs,
    "tx_row_count": q_tx_row_count,
    "tx_parse_lines": q_tx_parse_lines,
    "tx_filter_all": q_tx_filter_all,
    "tx_filter_country": q_tx_filter_country,
    "tx_pairs_all": q_tx_pairs_all,
    "tx_pairs_country": q_tx_pairs_country,
    "tx_pair_count": q_tx_pair_count,
    "popularity_grouped": q_popularity_grouped,
    "popularity_reduced": q_popularity_reduced,
    "popularity_top_h": q_popularity_top_h,
    "popularity_sorted": q_popularity_sorted,
    "popularity_report": q_popularity_report,
}

_POP_ALL = "SELECT product, count(*) AS popularity FROM (SELECT DISTINCT product, customer_id FROM kept) GROUP BY product"

ORACLES = {
    "tx_row_count": TX_SQL + "SELECT count(*) AS n_rows FROM tx",
    "tx_parse_lines": TX_SQL + "SELECT product, quantity, customer_id, country FROM tx",
    "tx_filter_all": TX_SQL + "SELECT product, quantity, customer_id, country FROM kept",
    "tx_filter_country": TX_SQL + f"SELECT product, quantity, customer_id, country FROM kept WHERE country = '{COUNTRY}'",
    "tx_pairs_all": TX_SQL + "SELECT DISTINCT product, customer_id FROM kept",
    "tx_pairs_country": TX_SQL + f"SELECT DISTINCT product, customer_id FROM kept WHERE country = '{COUNTRY}'",
    "tx_pair_count": TX_SQL + "SELECT count(*) AS pair_count FROM (SELECT DISTINCT product, customer_id FROM kept)",
    "popularity_grouped": TX_SQL + _POP_ALL,
    "popularity_reduced": TX_SQL + _POP_ALL,
    "popularity_top_h": TX_SQL + f"SELECT * FROM ({_POP_ALL}) ORDER BY popularity DESC, product LIMIT {TOP_H}",
    "popularity_sorted": TX_SQL + f", p AS ({_POP_ALL}) "
                         "SELECT 1 AS variant, product, popularity FROM p "
                         "UNION ALL SELECT 2 AS variant, product, popularity FROM p ORDER BY variant, product",
    "popularity_report": TX_SQL + f", p AS (SELECT product, count(*) AS popularity FROM "
                         f"(SELECT DISTINCT product, customer_id FROM kept WHERE country = '{REPORT_COUNTRY}') "
                         f"GROUP BY product) SELECT 1 AS variant, product, popularity FROM p "
                         f"ORDER BY popularity DESC, product LIMIT {REPORT_H}",
}

ORACLES["tx_file_row_count"] = ORACLES["tx_row_count"]
ORACLES["tx_file_pairs"] = ORACLES["tx_pairs_country"]
ORACLES["popularity_report_all"] = TX_SQL + (
    ", p AS (SELECT product, count(*) AS popularity FROM "
    f"(SELECT DISTINCT product, customer_id FROM kept WHERE country = '{REPORT_COUNTRY}') GROUP BY product) "
    "SELECT 1 AS variant, product, popularity FROM p UNION ALL SELECT 2 AS variant, product, popularity FROM p ORDER BY variant, product")
