"""Corpus preparation and audit operators for Apache Spark."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors by value, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
