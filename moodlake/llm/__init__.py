"""Operators for preparing training data at corpus scale.

One module per operator; ``queries`` registers them, ``oracle_sql`` holds the
SQL twins. Nothing outside this subpackage imports it. Functions of this
subpackage that run inside Spark tasks are pickled by value, so executors need
only the third-party libraries, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
