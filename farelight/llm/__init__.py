"""Operators for large-scale training data, their registered queries and equivalent SQL."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry these modules along; they need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
