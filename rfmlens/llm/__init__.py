"""Training-data operators.  Nothing outside this package imports it.

Task functions are pickled with their code, so that executors need no copy of
this package on their Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
