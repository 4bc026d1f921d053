"""Retail event and change-data analytics on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Workers get the few Python functions by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
