"""Training-data operators: quality, language-model score, PII, HTML, toxicity,
mixing, near duplicates and packing.  Nothing else in the library imports this
subpackage."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# functions of this package travel to executors by value, so that a cluster
# needs no copy of the package on its machines
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
