"""Hourly usage series on Spark: aggregate, densify, window, train, forecast, score."""

import sys

from pyspark import cloudpickle

# Tasks carry the package's functions along, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
