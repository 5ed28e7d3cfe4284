"""Operators for preparing training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Executors get these functions with the task, so they need no copy of the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
