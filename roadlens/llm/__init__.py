"""Operators of a training-data pipeline: language identification, language
model scoring, source mixing, URL filters, secret scans, packing, nearest
neighbours, quality rules, near-duplicates and token counts.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Task functions run in Python workers: their code is shipped by value, so
# executors need no installed copy of the subpackage.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
