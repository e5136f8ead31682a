"""Operators of a training-data pipeline, and the queries that apply them."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions with the job: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
