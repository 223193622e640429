"""Training-data operators: mixing, chat formatting, toxicity, near-duplicates,
language-model scoring, secret and licence scans, packing and quality rules.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are pickled by value, so they travel with the job and workers
need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
