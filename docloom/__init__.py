"""docloom: document ingest, chunking, retrieval and batch prompting as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry this package's code with them, so it need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
