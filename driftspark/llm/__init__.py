"""Operators of a training-data pipeline; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Workers need no copy of the package: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
