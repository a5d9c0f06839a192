"""Data mining on Spark DataFrames: profiling, cleaning, page mining, baskets, models, forecasts."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions travel to the Python workers by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
