"""pagemill: web-content analytics as PySpark DataFrame functions and Column expressions."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python helpers travel inside the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
