"""Operators for large training corpora.

Nothing outside this subpackage imports it; `corpus_pipeline.py` and the
queries in `queries.py` are its only users.
"""

import sys

from pyspark import cloudpickle

# Task code travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
