"""Operators for large training-data pipelines. Nothing else in the library imports this package.

Functions that run inside Python tasks travel with the task, so executors need not have this
package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
