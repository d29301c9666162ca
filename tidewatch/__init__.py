"""Brand-mood monitoring on Spark: batch and Structured Streaming."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job; executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
