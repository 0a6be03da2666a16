"""Operators for preparing training text: extraction, filtering, dedup, packing.

Each module holds one operator with a general interface; ``queries`` binds
them to the given tables.  Nothing outside this package imports it.

Functions that run inside tasks are shipped by value, so executors do not need
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
