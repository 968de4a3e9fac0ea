"""Operators for training-data pipelines.  Nothing outside this folder imports it.

Functions that run inside tasks travel with their code, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
