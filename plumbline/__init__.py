"""Statistics over arbitrarily large tables, written as Spark jobs.

``sources``    reading tables and shaping columns
``functions``  normal distribution as Column expressions, tails of test statistics
``plans``      the shared distributed building blocks (order statistics, ranks, Gram sums)
``operators``  the statistics themselves, DataFrame in, DataFrame out
"""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors by value, so that workers need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
