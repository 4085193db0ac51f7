"""Operators of a training-data pipeline: ten numbered operators and what they share.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it. Functions that run in Python
workers are pickled by value, so executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
