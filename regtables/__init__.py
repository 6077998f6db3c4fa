"""Regulatory tables on Spark: messy public records in, checked and traceable tables out."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to the executors with the job, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
