"""Operators for preparing training data.

Functions of this package that run in tasks are sent with the tasks, so the package need
not be installed on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
