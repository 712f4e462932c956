"""Batch-by-batch clustering of tandem mass spectra on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Arrow kernels travel to executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
