"""Operators for preparing language-model training data, one module per operator.

Nothing else in the library imports this subpackage.  ``queries`` registers one
query per operator, ``oracle`` holds the SQL of those that SQL can express.
"""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
