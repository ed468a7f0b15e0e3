"""Popularity, distance, ball, k-center, coreset and objective operators.

The few functions that run inside Python tasks are shipped by value, so executors need numpy
and pyarrow, not this package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
