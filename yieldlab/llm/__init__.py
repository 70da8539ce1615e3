"""Operators for preparing training corpora: fingerprints, near-duplicate and
substring removal, language-model and quality scores, tokenisation, mixing,
token counts and WARC archives. Nothing else in the library imports this
subpackage.

Task code is pickled by value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
