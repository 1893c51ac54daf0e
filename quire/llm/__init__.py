"""Training-data operators: each module holds one operator with a general
interface; :mod:`quire.llm.queries` applies them to whole tables.

Functions that run in Python workers are pickled by value, so executors need
no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
