"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Functions that run on executors are sent with the jobs, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
