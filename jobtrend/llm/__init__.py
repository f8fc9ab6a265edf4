"""Operators for preparing large text corpora.

Thirteen operators (one module each), the queries that apply them to the test tables
(``queries``) and their DuckDB statements (``sql``). Nothing outside this folder
and ``corpus_pipeline.py`` imports it.

Functions that run in Python workers are shipped by value, so executors need the
public libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
