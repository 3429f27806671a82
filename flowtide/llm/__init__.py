"""Operators for preparing training text: filters, dedup, archives, tokens.

Functions of this package travel to Python workers by value, so executors need not have
it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
