"""Passages on Spark: chunk, index, search and answer over document collections."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions sent to Python workers carry their code along, so executors need no
# installation of this package.
register_pickle_by_value(sys.modules[__name__])
