"""Operators for preparing language-model training data.

One module per operator; ``queries`` registers them. Nothing else in the
library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage that run in Python workers travel with the job,
# so executors need numpy, pyarrow and the named libraries, but no installed
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
