"""babelframe: Spark-native operators for multilingual caption corpora.

Every public operator takes and returns a ``pyspark.sql.DataFrame``; the row
work runs in Catalyst expressions or Arrow-batched pandas functions inside
Spark tasks, and all grouping goes through Spark shuffles.
"""

from __future__ import annotations

import sys as _sys

# Functions used inside Arrow UDFs / mapInPandas are shipped to executors by
# value, so workers never need this package on their PYTHONPATH.
try:  # pragma: no cover - depends on the pyspark build
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass

__all__ = ["__version__"]
__version__ = "0.1.0"
