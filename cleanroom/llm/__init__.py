"""Operators for training-data pipelines; nothing else in the library imports this subpackage.

Functions that run inside Python workers are shipped by value, so that executors need
no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
