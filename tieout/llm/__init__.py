"""Operators of a training-data pipeline. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Tasks get the operators' code with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
