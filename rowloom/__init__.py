"""Metadata-driven normalization of numbered XML records on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their tasks, so executors do
# not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
