"""Operators of a training-data pipeline over text tables.

Code that runs in Python workers lives in this subpackage and is shipped with
each job, so executors need its libraries but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
