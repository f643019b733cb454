"""Operators of a training-data pipeline; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Task code travels by value: executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
