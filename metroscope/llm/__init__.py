"""Operators for training-data pipelines: thirteen independent operators plus shared helpers.

Nothing outside this subpackage imports it. Each operator module keeps a general
DataFrame interface; ``queries.py`` holds the thin registered queries and ``oracle.py``
their DuckDB SQL where SQL can express them.
"""
import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
