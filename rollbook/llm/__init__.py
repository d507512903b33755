"""Operators that prepare text corpora for training. Nothing else here imports them.

Functions that run in Python workers are sent with their code, so the workers need not
have this package installed.
"""

import sys

from pyspark.cloudpickle import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
