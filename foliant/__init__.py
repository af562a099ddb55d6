"""foliant: Spark-native inventory, matching, batching and assembly jobs for a
large shared document tree."""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package travel to the Python workers by value, so a job
# also runs where the package is installed on the driver alone.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
