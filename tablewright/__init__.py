"""Tablewright: record consolidation, freshness reporting and text operators as PySpark table jobs."""

import sys

from pyspark import cloudpickle

# Functions used inside tasks travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
