"""Colocalisation of association signals as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions that run in tasks travel with the job, so executors need
# numpy and pandas but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
