"""Operators of a large-scale training-data pipeline.

One module per operator, ``queries`` registers one query for each. Nothing
outside this package imports it; ``__spark_entry__`` adds its queries only when
it can be imported.

Functions that run inside tasks are shipped by value, so executors need no
copy of this package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
