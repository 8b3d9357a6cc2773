"""leafwork: document analytics on Spark.

Decks and pages become DataFrames of shapes and blocks; pictures are registered by content hash,
described once, spliced back in reading order and rendered.  Everything after the binary scan is
DataFrame work.  Operators for training data live in ``leafwork.llm``, which nothing here imports.
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run in Python workers travel by value: executors need no copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
