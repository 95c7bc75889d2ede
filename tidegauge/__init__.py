"""tidegauge: sensor and event-stream analytics on Spark DataFrames."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

__version__ = "0.1.0"

# Functions and processors go to the Python workers with their code, so the package need
# not be installed on the executors.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
