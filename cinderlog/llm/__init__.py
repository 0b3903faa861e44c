"""Operators for preparing language-model training data.

Nothing else in the library imports this package. Its functions travel to the workers by
value, so that executors need the libraries they call but not the package itself."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
