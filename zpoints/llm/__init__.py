"""Operators for training-data pipelines. Nothing else in the library imports this subpackage.

The package is pickled by value, so executors need numpy, pyarrow and pandas
but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
