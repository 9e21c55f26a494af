"""farebox: trip and question analytics expressed as Spark DataFrame / SQL /
Structured Streaming operators.

Sub-packages:
  sources    – file, seed, JDBC and paginated REST readers
  functions  – Column -> Column helpers (names, ids, time, JSON)
  operators  – normalisation, unions, joins, revenue, dedupe, tags,
               quality checks, sessions, scoring and sinks
  plans      – the user-visible models composed from operators, and the
               mapping of the benchmark tables onto the trip / question domain
  streaming  – stream sources, windowed aggregates and stream sinks
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package that run inside Python workers (pandas scoring,
# data source readers) are shipped by value, so executors need no copy of
# the package on their path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
