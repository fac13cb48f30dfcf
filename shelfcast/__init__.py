"""Retail analytics as Spark jobs: every operator is a ``DataFrame -> DataFrame`` function."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions that run on executors travel with their tasks: nothing to install there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
