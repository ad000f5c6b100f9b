"""Operators of a training-data pipeline, each by one named method.

Functions that run in Python workers are sent by value, so executors need only
Python with the listed packages, not this library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
