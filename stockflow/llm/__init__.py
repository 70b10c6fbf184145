"""Operators for preparing training data of language models; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Tasks get the code of these modules with their functions, so executors need only the public libraries.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
