"""Operators of a training-data pipeline (deduplication, scans, language, tokens, chat).

Functions that run in Spark's Python workers are sent by value, so executors
need this package's dependencies but not the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
