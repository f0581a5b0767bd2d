"""Operators for training-data pipelines: scoring, deduplication, decontamination, mixing, formatting.

Nothing else in the library imports this subpackage. Functions that run in Python workers are
shipped by value, so executors need only the third-party libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
