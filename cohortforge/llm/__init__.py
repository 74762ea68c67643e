"""Operators for training-data corpora: each works on whole tables of documents, pages or conversations.

Nothing outside this package and `corpus_pipeline.py` imports it. Functions that run in Python
workers are shipped by value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
