"""Operators of a training-data pipeline over documents, pages, vectors and chats.

Functions that run inside Python workers are pickled by value, so that executors
need no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
