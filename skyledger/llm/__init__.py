"""Operators for preparing language-model training data. Nothing outside this folder imports it.

Functions that run in Python workers are sent by value, so executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
