"""criba: a PySpark engine for multi-source retail price data.

Text and field parsers, capture-file ingestion, row quarantine, schema drift,
attribute history, robust statistics, entity resolution and data-quality checks,
all as functions from DataFrame to DataFrame or Column to Column.
"""

from pyspark import cloudpickle as _cloudpickle

import sys as _sys

# Functions of this package travel to the Python workers with the query, so a
# cluster need not have the package installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
