"""Operators: pure functions from DataFrame (+ parameters) to DataFrame."""
import sys

from pyspark import cloudpickle

# functions of this package travel with their closures: executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
