"""Spark jobs over omics-shaped tables: variants, cells, bulk counts, reads, splicing."""

import sys

from pyspark import cloudpickle

# Functions of this package that run inside tasks travel with the job, so that
# executors need no copy of the package on their Python path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
