"""Operators of a training-data pipeline: decontamination, deduplication, scoring, archives, packing, search."""

import sys

from pyspark import cloudpickle

# Executors need not have this package: what tasks run travels with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
