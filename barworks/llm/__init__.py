"""Operators for training-data pipelines: text in, text or verdicts out.

Nothing else in the library imports this subpackage. Its functions travel to the
executors by value, so a cluster needs the third-party packages but no copy of
this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
