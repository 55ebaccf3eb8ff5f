"""Conversation analytics expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions sent to executors travel with their code, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
