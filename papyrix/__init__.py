"""Document-intelligence and retrieval engine on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Executors get the package's functions with the plan, so that it needn't be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
