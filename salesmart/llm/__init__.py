"""Operators for preparing training data: search, deduplication, filtering, packing.

Functions that run inside Python workers are sent by value, so executors need
numpy, pandas and Arrow, but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
