"""Training-data operators (packing, deduplication, cleaning, scoring, extraction).

Each module holds one operator with its own general interface. ``queries.py`` registers the
thin ``opN_<name>`` queries. Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so that executors need no
# copy of it on their path. Shipped functions name functions, not modules of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
