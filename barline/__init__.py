"""barline: panel preparation, forecasting and scoring of daily bars as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# The few NumPy helpers travel inside the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
