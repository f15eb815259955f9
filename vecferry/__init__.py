"""vecferry: move search-index documents into vector-ready tables and query them, on Spark.

Every public function takes and returns DataFrames or Columns. Functions shipped to Python
workers are pickled by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
