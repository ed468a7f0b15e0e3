import __spark_entry__ as entry_mod
from conftest import SF_SMALL


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert df.columns == ["product", "popularity"]


def test_every_oracle_has_a_query():
    qs = entry_mod.queries()
    assert set(entry_mod.oracle_sql()) <= set(qs)


def test_cheap_queries_run_on_smallest_scale(spark):
    qs = entry_mod.queries()
    for name in ["tx_pair_count", "points_parse", "initial_guess", "objective_points", "ball_weights"]:
        assert qs[name](spark, SF_SMALL).count() >= 1
