"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage.

Kernels run inside ``mapInArrow`` / ``applyInArrow``; they are pickled by value, so executors need
no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
