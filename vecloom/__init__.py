"""Text embeddings and semantic search expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Ship the package's own functions inside each task, so executors need no copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
