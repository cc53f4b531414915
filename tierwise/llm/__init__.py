"""Operators for training-data pipelines, kept apart from the rest of the library."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
