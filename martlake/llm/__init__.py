"""Operators for preparing large text corpora for model training.

Each module is one operator with a DataFrame-in, DataFrame-out interface;
``queries`` applies each of them, with its production parameters, to the given
tables.  Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value, so a cluster needs no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
