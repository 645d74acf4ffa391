"""Source-code analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python tasks carry the functions they need; executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
