import os
import tempfile

import pytest

from pinwheel.operators import popularity as pop
from pinwheel.sources.text import read_points, read_transactions


def _write(folder, name, lines):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_read_points_keeps_file_order(spark):
    folder = tempfile.mkdtemp(prefix="pinwheel-pts-")
    for f in range(3):
        _write(folder, f"points-{f}.txt", [f"{f * 1000 + i}.5,{-i}," for i in range(60)])
    # Small splits: every file is cut into several splits that land in partitions out of order.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        pts = read_points(spark, folder).orderBy("ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["ord"] for r in pts] == list(range(180))
    assert [r["id"] for r in pts] == list(range(180))
    want = [[f * 1000 + i + 0.5, float(-i)] for f in range(3) for i in range(60)]
    assert [list(r["coords"]) for r in pts] == want


def test_read_points_survives_other_splits(spark):
    """Settings that would cut the files otherwise between the two passes lose no line."""
    folder = tempfile.mkdtemp(prefix="pinwheel-pts-")
    for f in range(4):
        _write(folder, f"points-{f}.txt", [f"{f * 5000 + i},{i % 7}" for i in range(5000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        df = read_points(spark, folder)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4000000")
        spark.conf.set("spark.sql.files.minPartitionNum", "41")
        rows = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert len(rows) == 20_000 and all(r["coords"][0] == r["id"] == r["ord"] for r in rows)


def test_read_points_rejects_bad_number(spark):
    folder = tempfile.mkdtemp(prefix="pinwheel-pts-")
    _write(folder, "points.txt", ["1,2", "3,x"])
    with pytest.raises(Exception):
        read_points(spark, os.path.join(folder, "points.txt")).collect()


def test_read_transactions_from_text(spark):
    folder = tempfile.mkdtemp(prefix="pinwheel-tx-")
    _write(folder, "tx.csv", ["a,p1,x,2.0,y,z,10,France", "a,p1,x,3.0,y,z,10,France",
                              "a,p2,x,1.0,y,z,11,France", "a,p2,x,-1.0,y,z,12,France"])
    tx = read_transactions(spark, folder, partitions=3)
    assert pop.row_count(tx).collect()[0]["n_rows"] == 4
    got = {(r["product"], r["popularity"]) for r in
           pop.popularity_reduced(pop.product_customer_pairs(tx, "France")).collect()}
    assert got == {("p1", 1), ("p2", 1)}
