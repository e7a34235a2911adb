"""Training-data operators: mixing, quality rules, deduplication, archives,
tokenisation, token stores, sharding and exact search.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are shipped by value, so a cluster needs no copy of it.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
