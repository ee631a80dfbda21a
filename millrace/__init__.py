"""Spark-native analytics for prices, economic indicators and housing data.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns).  Nothing here keeps a global session or prints.
"""

import sys

from pyspark import cloudpickle

# Code that runs in Python workers travels with the task, so executors need not have
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
