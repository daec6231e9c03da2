"""Operators of a training-data pipeline over ``documents`` and ``embeddings``.

Python functions of this package travel to the executors by value, so a
cluster needs no copy of the package on its Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
