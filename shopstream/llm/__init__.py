"""Operators of a training-data pipeline: mixing, dedup, language, quality, tokens, shards."""

import sys

from pyspark import cloudpickle

# Workers get the functions of this package by value: they need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
