"""Retail sales forecasting data work on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from salesline.session import get_session

# Functions that run in tasks travel with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_session"]
