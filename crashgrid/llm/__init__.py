"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``benchmark``.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` has the thin registered queries
and ``oracle`` their SQL where SQL can express them.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value: executors need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
