"""Training-data operators: one module per operator, queries in ``queries``."""

import sys

from pyspark import cloudpickle

# Python functions that run in tasks travel with their code, so that workers
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
