"""Operators for a text-corpus pipeline. Nothing else in the library imports this package.

Functions handed to executors travel by value, so workers need only numpy, pandas,
pyarrow and (for packing) tokenizers, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
