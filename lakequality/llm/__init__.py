"""Operators that prepare training data: one module for each, `queries` registers them.

Nothing else in the library imports this package. Functions that run inside tasks travel by value,
so executors need NumPy and Arrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
