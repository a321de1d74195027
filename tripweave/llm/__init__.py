"""Operators for preparing language-model training text: filters, deduplication, packing.

Functions of this package that run in tasks are sent along with them, so that it need not be
installed on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
