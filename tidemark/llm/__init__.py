"""Operators for training-data pipelines: deduplication, tokens, archives, packing, mixing.

Functions that run in Python tasks are shipped with the job, so executors need numpy and
pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
