"""Operators for training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so that these need
# no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
