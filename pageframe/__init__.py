"""Web-page analytics on Spark: pages become rows of document nodes, everything else is DataFrames."""

import sys

from pyspark import cloudpickle

# Executors receive the few Python functions that run in tasks by value, so a job needs nothing but
# PySpark installed on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
