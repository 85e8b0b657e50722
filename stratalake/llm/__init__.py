"""Operators that prepare text, pages, vectors and conversations for training language models.

Functions of this subpackage travel to the executors by value, so a cluster
needs only the public libraries they import, not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
