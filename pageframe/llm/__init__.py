"""Operators of a training-data pipeline over documents, pages and benchmark texts."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks travel by value: executors need the listed libraries, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
