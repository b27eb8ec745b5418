"""Operators of a training-data pipeline: packing, dedup, classifiers, language ID, sharding, PII, search, BPE.

Nothing else in the library imports this subpackage. Its functions run inside Spark's Python workers, so
they are shipped by value: executors need Spark's own Python libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
