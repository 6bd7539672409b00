"""Operators for training-data pipelines.

Functions of this package that run on executors are pickled by value, so the executors need no copy of
the repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
