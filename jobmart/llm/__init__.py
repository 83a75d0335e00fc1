"""Operators for training-data pipelines.  Nothing outside this folder imports them."""

import sys

from pyspark import cloudpickle

# Send the Python functions of this folder to executors by value: they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
