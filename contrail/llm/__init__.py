"""Operators of a training-data pipeline: filters, deduplication, tokenizing, packing, archives.

Nothing else in the library imports this subpackage. Functions that run in Python workers are shipped
with the job (pickled by value), so executors need numpy, pandas and the small helper libraries but not
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
