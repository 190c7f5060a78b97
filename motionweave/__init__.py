"""motionweave: motion-trajectory analytics as Spark DataFrame programs."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
