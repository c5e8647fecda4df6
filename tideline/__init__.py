"""Time-series analytics on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package that run inside tasks travel with the job, so executors need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
