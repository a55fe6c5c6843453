"""Operators for preparing training data, and their queries."""

import sys

from pyspark import cloudpickle

# Executors need not have this package: the functions that run in tasks are sent by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
