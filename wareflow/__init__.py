"""Product-catalogue processing on Spark: plain DataFrame and Column functions."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with their code, so workers need not have
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
