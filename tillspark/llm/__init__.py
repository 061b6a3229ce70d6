"""Training-data operators: one module per operator, each with its query.

Functions that run inside Spark tasks are pickled by value, so workers need no copy of
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
