"""Operators of a training-data pipeline (dedup, filters, packing, chat records).

Nothing else in the library imports this package.  Its functions travel to
Python workers by value, so executors need no copy of the library itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
