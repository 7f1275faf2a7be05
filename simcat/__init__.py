"""simcat: catalogue cleaning, profiling, feature building and top-k similarity on Spark.

Every public operator takes and returns DataFrames; the heavy work runs as Spark
joins, aggregations, windows and Arrow-batched pandas functions over partitions.
"""

import sys as _sys

__version__ = "0.1.0"

# Functions that run inside Python workers (mapInPandas / applyInPandas) are
# shipped by value, so executors need no installed copy of this package.
try:  # pragma: no cover - depends on the PySpark build
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
