"""scorekit: profiling, cleaning, features, cross-fitting, exact metrics and ensembling on Spark.

Modules: ``operators.order`` (exact global order), ``operators.stats`` (exact quantiles),
``operators.profile``, ``operators.clean``, ``operators.features``, ``operators.cardio``,
``operators.metrics``, ``operators.ensemble``, ``operators.crossfit``, ``operators.models``,
``operators.boosting``, ``operators.extratrees``, ``operators.trees``, ``operators.calibration``,
``operators.knn``, ``operators.joins``, ``operators.reconcile``, ``operators.select``,
``functions.scalar``, ``sources.io``, ``streaming.scoring``; ``plans`` holds the registered queries.

Functions that run in tasks are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

from .spec import TableSpec  # noqa: F401

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
