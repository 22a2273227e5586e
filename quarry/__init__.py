"""quarry: corpus preparation for language-model training, as Spark jobs.

Raw text and conversation records are cleaned, chunked, rendered with a chat
template, tokenized with a byte-level BPE that is trained as a Spark job, and
turned into padded / packed / loss-masked training sequences and reproducible
batch plans.  Every operator is a DataFrame -> DataFrame (or Column -> Column)
function; see README.md for the map from operator ids to modules.
"""

__version__ = "0.1.0"

# Python workers (Arrow UDFs, mapInArrow, applyInPandas) need the helper code
# they run.  Pickling this package by value ships it with each task, so
# executors need no installed copy and no shared file system.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without by-value support
    pass
