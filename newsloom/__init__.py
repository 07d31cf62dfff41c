"""Curation of article collections as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the task; nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
