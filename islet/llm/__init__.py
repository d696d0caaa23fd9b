"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing else in the library imports this package.  Each module holds one
operator with a general interface; ``queries`` applies them to the driver's
tables and ``sql`` holds the SQL of those that SQL can express.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel with their jobs: executors need no copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
