"""Operators for preparing training text; nothing else in the library imports this package.

Functions that run on executors travel by value, so a cluster needs no copy of
this package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
