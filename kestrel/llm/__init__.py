"""Operators of a training-data pipeline over documents, pages and conversations.

Each module holds one operator with a general interface (DataFrames and plain
parameters in, a DataFrame out); ``queries.py`` registers one query per operator.
Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to Python workers by value, so that executors need no
# copy of it on their own import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
