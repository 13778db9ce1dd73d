"""Operators of a training-data pipeline (sharding, near-duplicates, mixing,
fingerprints, language ID, tokenisation, archives).

Nothing else in the library imports this subpackage.  Functions that run on
Python workers are pickled by value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
