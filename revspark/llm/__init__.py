"""Operators and queries of a training-data pipeline.

Nothing outside this folder imports it.  Functions that run in Python
workers are pickled by value, so executors need the libraries they use
(numpy, pyarrow) but no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
