"""Operators that prepare training text for language models; nothing else in the package uses them."""

import sys

from pyspark import cloudpickle

# functions travel to executors by value, so they need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
