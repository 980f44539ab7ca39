"""Operators for preparing language-model training data.

Their tasks carry these functions with them, so executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
