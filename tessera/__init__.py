"""tessera: catalogue-style analytics operators on Spark DataFrames.

Every public operator takes DataFrames (plus plain Python parameters) and
returns a DataFrame.  Nothing is collected inside an operator; the caller
decides when to act.
"""

import sys as _sys

from tessera.session import get_spark, scratch_path

# Ship tessera's own functions (the few pandas-UDF bodies) to Python workers
# by value, so executors need no installed copy of the package.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

from tessera.plans.catalogue import CardData  # noqa: E402

__all__ = ["CardData", "get_spark", "scratch_path"]
