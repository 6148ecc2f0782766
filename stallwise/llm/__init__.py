"""Operators for training-data pipelines.

Functions of this package travel to executors by value, so workers need not find the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
