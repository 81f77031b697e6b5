"""millrace: a PySpark-native entity-registry engine.

Python functions that Spark ships to executors are pickled by value, so a cluster
needs no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
