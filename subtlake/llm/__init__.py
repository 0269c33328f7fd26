"""Operators for preparing training data; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# code that tasks run travels with them, as for the other modules
cloudpickle.register_pickle_by_value(sys.modules[__name__])
