"""News curation over Spark DataFrames: windows, rules, de-duplication, clustering, quotas, gates and search."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Ship the UDF helpers with the job itself, so that executors need no installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
