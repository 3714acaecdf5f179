"""cadenza: Spark-native regression analytics over DataFrames.

Sub-packages:
  sources    text lines, in-memory rows, delimited records, tar.gz archives, nested records
  functions  column expressions: parsing, dense-vector arithmetic, error metrics
  operators  profiling, feature stages, hash split, elastic net, gradient descent, tuning
  plans      stand-in fixtures, registered queries and their SQL oracles
  streaming  (the workloads are bounded; see its docstring)
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle functions from this package by value when Spark ships them to
    Python workers (mapInPandas/applyInPandas/pandas UDFs), so executors do
    not need the package on their import path."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except (ImportError, AttributeError, ValueError):
        pass


_ship_by_value()
