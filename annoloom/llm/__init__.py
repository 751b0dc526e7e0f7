"""Operators for preparing training data; nothing else in the library imports this package.

Functions that run in tasks are sent to the executors as code, so these need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
