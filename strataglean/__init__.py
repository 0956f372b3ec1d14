"""Mining and recommendation analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code: executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
