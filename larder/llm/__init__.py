"""Operators for preparing training text (nothing else in the library imports them).

Functions that run in Python workers are pickled by value, so executors need
no copy of this subpackage on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
