"""Operators of a training-data pipeline (LM scoring, near-dedup, packing, WARC, ...).

One module per operator; ``queries`` registers one query for each.  Nothing
outside this folder imports it.  Functions that run in Python workers are
pickled by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
