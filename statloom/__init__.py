"""Entity statistics on Spark: clean, merge, profile, rank, match, cluster and value entities."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the job, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
