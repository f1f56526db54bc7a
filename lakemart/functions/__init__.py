"""Column builders: everything here returns a ``pyspark.sql.Column``."""

from lakemart.functions.casts import lenient_cast, typed_null
from lakemart.functions.measures import count_where, mean, n, n_of, share_where
from lakemart.functions.numeric import rounded, row_mean, safe_ratio
from lakemart.functions.predicates import all_of, eligible
from lakemart.functions.recode import (bucket_by_membership, by_period, code_to_bool,
                                       harmonize, lookup_dense, lookup_text, map_codes,
                                       members)

__all__ = [
    "lenient_cast", "typed_null", "n", "n_of", "mean", "count_where", "share_where",
    "rounded", "row_mean", "safe_ratio", "all_of", "eligible", "map_codes", "harmonize",
    "by_period", "code_to_bool", "bucket_by_membership", "lookup_dense", "lookup_text", "members",
]
