"""Pages and documents to retrieval and graph tables, on Spark."""

import sys

from pyspark import cloudpickle

# Executors get the few Python functions by value, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
