"""Operators for preparing language-model training data, and their registered queries.

Nothing outside this package and `corpus_pipeline.py` imports it. Code that runs in tasks is shipped with them,
so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
