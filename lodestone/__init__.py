"""Spark-native corpus building, retrieval and evaluation operators.

Every public function takes and returns DataFrames.  Nothing here runs a job
on its own except where a docstring says so (size checks before a broadcast,
sinks, and streaming queries).
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code with them, so executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
