"""Operators for preparing training data at corpus scale.

Functions of this package travel to the executors by value, with those they use of
the rest of the library, so that a cluster need not have it installed.
"""

import sys

from pyspark import cloudpickle

# The whole library: functions here refer to modules, which are sent as well.
cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])
