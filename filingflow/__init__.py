"""PySpark-native engine for captured financial-disclosure data.

Functions of this package that run on Python workers (the ``mapInPandas``
parsers) are pickled by value, so executors need no installed copy of the
package; ``--py-files`` / ``SparkContext.addPyFile`` work as well.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(sys.modules[__name__])
