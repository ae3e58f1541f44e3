"""Operators for large text corpora: counting, mixing, fingerprints, scoring, dedup, search, packing."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package
