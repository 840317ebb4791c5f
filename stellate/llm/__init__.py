"""Operators for preparing training text: deduplication, filtering, extraction, encoding.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface; ``catalog`` derives the registered
``opN_<name>`` queries from them.
"""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the job: executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
