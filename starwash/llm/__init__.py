"""Operators of a training-data pipeline over documents, pages, labels, benchmark items and conversations.

Functions of this package that run in Python workers travel with the task, so that the executors need no
copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
