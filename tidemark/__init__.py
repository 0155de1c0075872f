"""Post-sentiment and operations analytics as Spark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers get our functions by value, so the package need not be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
