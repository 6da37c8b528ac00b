"""Spark-native engine for ordered observation streams and document retrieval."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the plan: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
