"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Functions that run inside Spark tasks
are shipped by value, so executors need only numpy, pyarrow and the standard library (and
``regex`` and ``xxhash`` where an operator says so), not this package on their import path.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def llm_queries():
    from pinwheel.llm import queries
    return dict(queries.QUERIES)


def llm_oracles():
    from pinwheel.llm import queries
    return dict(queries.ORACLES)
