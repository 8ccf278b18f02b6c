"""Operators of a training-data pipeline over document tables; nothing else in the library uses them."""

import sys

from pyspark import cloudpickle

# Functions for tasks travel whole, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
