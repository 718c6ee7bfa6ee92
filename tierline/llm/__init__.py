"""Operators for training-data pipelines.

Functions of this subpackage that run inside Python workers are shipped with
the tasks (pickled by value), so executors need no copy of the library.
Nothing outside this subpackage and ``corpus_pipeline.py`` imports it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
