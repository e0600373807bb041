"""Operations of a large-scale training-data pipeline on tables of texts."""

import sys

from pyspark import cloudpickle

# What tasks run is sent to them whole, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
