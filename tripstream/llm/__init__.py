"""Operators of a training-data pipeline (personal data, packing, near copies, decontamination, archives).

Nothing else in the library imports this subpackage; ``queries`` registers one
query per operator and ``oracle`` holds the SQL of those that SQL can state.
"""

import sys

from pyspark import cloudpickle

# functions and classes of this subpackage travel with the tasks that use them, so
# executors need numpy, pandas and the tokenizer library, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
