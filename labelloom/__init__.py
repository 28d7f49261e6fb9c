"""Turn unlabelled text into a labelled dataset with Spark DataFrame jobs."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

__version__ = "0.1.0"

# Functions that run inside tasks travel with the task, so executors do not
# need this package installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
