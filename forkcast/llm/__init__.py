"""Operators of a training-data pipeline, each by one named method.

Nothing outside this folder imports it.  Its functions travel to executors
by value, so a cluster needs no copy of the package on the workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
