"""Operators for preparing language-model training data.

Functions that run inside tasks travel with the task, so executors need the
third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
