"""Operators for preparing training data: filtering, de-duplication, mixing, packing, archives."""

import sys

from pyspark import cloudpickle

# Workers get the functions themselves, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
