"""Operators of a training-data pipeline: archives, filters, near-duplicate
search, language models, tokenised output, packing and sharding.

Code that runs inside tasks is pickled by value, so executors need no copy of
this package on their path.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
