"""Operators for large-scale training-data pipelines.

Ten operators over the ``documents``, ``pages`` and ``labels`` tables, one per
module, plus their registered queries (``queries.py``). Nothing else in the
library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage run inside Python workers; shipping them by value
# means executors need no copy of the repository on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
