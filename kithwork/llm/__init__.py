"""Operators for preparing training text: deduplication, filtering, extraction, scoring and packing.

Functions that run in tasks are shipped by value, so executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
