"""Training-data operators: deduplication, filters, scoring, mixing, tokens.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  The
modules are pickled by value, so executors need pyspark, numpy, pyarrow and,
for op 9, the tokenizer libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
