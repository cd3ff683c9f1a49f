"""Training-data operators: near-duplicates, decontamination, language
models, tokenizers, language ID, fingerprints, toxicity, line dedup,
sharding and token files. Nothing else in the package imports this one.

Functions of this package travel to the executors by value, so a job needs no
installed copy of it there. What tasks share (models, tables) is broadcast as
plain containers and arrays.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
