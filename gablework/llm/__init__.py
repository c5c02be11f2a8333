"""Operators for training data: filters, near duplicates, tokens, packing.

Nothing else in the library imports this subpackage.  Functions that run on
executors are shipped by value, so workers need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
