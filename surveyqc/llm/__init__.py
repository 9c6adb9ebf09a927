"""Operators for preparing language-model training text, one module per method.

Their Python functions travel to the executors with the job, so the package need not be
installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
