"""Hourly, location-level demand analytics expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Python functions that run inside tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
