from pinwheel.functions.distance import double_sql, euclidean, euclidean_sql, sqdist
from pinwheel.functions.parse import is_int, split_fields, strict_double, to_vector

__all__ = ["double_sql", "euclidean", "euclidean_sql", "sqdist", "is_int", "split_fields", "strict_double", "to_vector"]
