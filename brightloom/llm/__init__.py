"""Training-data operators; queries and their SQL are in ``queries``. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
