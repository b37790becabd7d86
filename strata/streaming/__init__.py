"""Streaming jobs, their keyed state, and the replay harness."""

import sys

from pyspark import cloudpickle

# Keyed-state processors travel with their code; workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
