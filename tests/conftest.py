import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pinwheel.session import get_session
    session = get_session("local[4]", 4)
    yield session
    session.stop()


def points_df(spark, coords, weights=None, ids=None, ords=None, extra=None):
    """Point DataFrame from Python lists (test fixtures only)."""
    ids = list(range(len(coords))) if ids is None else ids
    ords = list(ids) if ords is None else ords
    rows = []
    for i, c in enumerate(coords):
        row = (int(ids[i]), int(ords[i]), [float(v) for v in c])
        if weights is not None:
            row = row + (int(weights[i]),)
        rows.append(row)
    schema = "id long, ord long, coords array<double>" + (", w long" if weights is not None else "")
    return spark.createDataFrame(rows, schema)
