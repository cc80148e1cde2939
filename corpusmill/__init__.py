"""Spark-native preparation of text corpora: normalise, filter, sample, mix, format, write."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with them, so executors need not have
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
