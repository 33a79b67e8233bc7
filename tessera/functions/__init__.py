"""Column-expression builders: predicates, similarity, hash-uniform draws."""

from tessera.functions.predicates import *  # noqa: F401,F403
from tessera.functions.predicates import __all__ as _pred_all
from tessera.functions.fuzzy import fuzzy_filter, fuzzy_join, fuzzy_pairs, fuzzy_prefilter, jaro_winkler_columns, jaro_winkler_score
from tessera.functions.random import hash_uniform, hash_bucket

__all__ = list(_pred_all) + ["fuzzy_filter", "fuzzy_join", "fuzzy_pairs", "fuzzy_prefilter",
                             "jaro_winkler_columns", "jaro_winkler_score", "hash_uniform", "hash_bucket"]
