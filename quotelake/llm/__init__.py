"""Operators for training-data pipelines: filters, deduplication, search, mixing, packing.

Nothing else in the library imports this subpackage.  Its Python task functions
are pickled by value, so executors need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
