"""Training-data operators.  Nothing else in the package imports this subpackage.

Each module holds one operator with its own general interface; ``catalog.py``
holds the registered queries.  Functions that run inside tasks are pickled by
value, so workers need not have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
