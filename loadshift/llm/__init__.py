"""Training-data operators: PII, mixing, quality rules, WARC, decontamination, secrets,
near-duplicate joins, URL filters, quality classifier and language identification."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel to the workers by value, so that executors need
# no copy of the repository on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
