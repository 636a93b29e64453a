"""Operators of a training-data pipeline over documents, pages and embeddings.

Functions of this subpackage travel to the executors by value, so that a job also
runs where the library is only installed on the driver.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
