"""A PySpark engine for catalogues of photo observations: build, look up, list work, enrich, and report."""

import sys

from pyspark import cloudpickle

# tasks bring along what they need of this package: workers need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
