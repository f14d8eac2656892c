"""Document and vector retrieval and table edits on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from .session import get_session

__all__ = ["get_session"]

# Functions of this package travel to the executors by value, so it needs to be
# installed (or on the path) only where the driver runs.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
