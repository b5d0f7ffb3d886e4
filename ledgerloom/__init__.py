"""ledgerloom: everyday analytics written as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers whole, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
