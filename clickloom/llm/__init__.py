"""Operators that prepare text and vectors for training language models.

Functions of this package travel to executors by value, so only Spark, numpy and the like have to be
installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
