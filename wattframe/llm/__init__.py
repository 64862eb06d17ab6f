"""Operators for preparing training data: texts and pages in, decisions and packed sequences out.

Nothing else in the library imports this package. Functions that run inside tasks travel with the
plan instead of being imported there, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
