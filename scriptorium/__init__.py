"""Document understanding over OCR output as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
