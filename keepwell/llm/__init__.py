"""Operators of a training-data pipeline over documents, embeddings and pages.

Nothing else in the library imports this package. Executors get its functions
by value, so they need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
