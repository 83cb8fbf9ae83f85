"""Operations of a training-data pipeline; nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value: executors need no copy of this folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
