"""Operators for preparing training text. Nothing else in the library imports this package.

Functions that run inside tasks are sent to the executors by value, so executors need no
copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
