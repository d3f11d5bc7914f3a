"""Operators for building language-model training data.

Functions that run in tasks are sent along by value, so executors need not have
this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
