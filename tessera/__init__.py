"""tessera: text retrieval and near-duplicate search as Spark DataFrame jobs.

Subpackages:
  functions  column expressions (tokenising, stemming, snippets, vectors)
  sources    readers for corpora, seed lists, pages and landed JSON
  operators  index build, Boolean search, rerank, kNN, duplicates, fuzzy names
  plans      named queries used by tests, the oracle check and the bench
  streaming  incremental index maintenance with Structured Streaming
"""

import sys as _sys

# Ship this package's code with every task: functions used inside pandas UDFs
# (stemmer, HTML parser, kNN kernels) are pickled by value, so executors need
# no installed copy of tessera and no PYTHONPATH set up.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass

from tessera.session import get_spark, checkpoint_dir  # noqa: E402

__all__ = ["get_spark", "checkpoint_dir"]
