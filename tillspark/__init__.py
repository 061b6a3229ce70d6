"""tillspark: retail sales cleaning, star-schema warehouse, reports and forecasting on Spark."""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Task functions are pickled by value, so Python workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
