"""Wallet and asset analytics as composable PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Executors get functions that run in tasks by value, so they need no copy of the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
