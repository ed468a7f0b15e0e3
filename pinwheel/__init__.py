"""pinwheel: product popularity and k-center-with-outliers analytics on Spark DataFrames.

Every operator takes and returns DataFrames. Order and partition identity, which the
questions depend on, are explicit columns (``ord``, ``part``), never physical layout.
"""

from pinwheel.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
