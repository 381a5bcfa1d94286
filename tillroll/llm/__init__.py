"""Operators for preparing large text corpora for model training.

Each module holds one operator and its model or index; ``queries`` registers them.
The functions that run inside tasks are shipped by value, so executors need no copy
of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
