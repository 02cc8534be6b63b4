"""gleaner: document ingestion and curation as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# the few functions that run in Python workers travel with the job: executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
