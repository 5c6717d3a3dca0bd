"""Operators of a training-data pipeline over a table of documents.

Nothing else in the library imports this package. Functions that run in Python
workers are pickled by value, so workers need not be able to import it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
