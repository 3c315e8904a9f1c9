"""tidemark: a Spark library for timestamped JSON records.

Every operator is a plain ``DataFrame -> DataFrame`` function; see the README for the layout.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions that run in Python workers travel with the job, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])
