"""Training-data operators over text, pages and embeddings. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so that they need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
