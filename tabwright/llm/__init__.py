"""Operators of a large-scale training-data pipeline (dedup, decontamination, filters, packing).

Nothing else in the package imports this one; ``queries.py`` lists its registered queries.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so a cluster's workers need
# nothing installed besides the public libraries.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
