"""Operators for preparing training text. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
