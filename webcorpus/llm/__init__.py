"""Operators of a training-data pipeline (near-duplicates, language-model
scores, archives, sharding, mixing, quality, decontamination, toxicity,
repeated passages, chat formatting) and their registered queries.

Nothing outside this package imports it.  The package's functions are sent to
Python workers by value, so executors need numpy and pyarrow but no copy of
this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
