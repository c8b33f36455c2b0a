"""Operators that prepare training data: packing, sharding, deduplication, filters, mixing, search.

Nothing outside this package imports it. Its functions travel to the executors by value, so a cluster needs
no copy of the library on its machines.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
