"""strata: lakehouse data jobs on the Spark DataFrame, SQL and streaming APIs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions used inside tasks travel with the task, so executors do not need
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
