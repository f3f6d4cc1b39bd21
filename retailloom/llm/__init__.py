"""Operators for preparing training data. Functions that run in Python workers travel by value, so that executors
need no copy of this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
