"""Operations of a training-data pipeline: filters, near-duplicates, tokens, packing.

Nothing else in the library imports this package. Functions that run in tasks are shipped by
value, so executors need the installed libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
