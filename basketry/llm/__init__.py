"""Operators for preparing training data, and their queries.

Functions of this package are sent to the executors by value, so that a cluster needs the
libraries only and no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
