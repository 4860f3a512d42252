"""Operators for preparing language-model training data.

Each module is one operator with its own interface; ``queries`` registers the
thin ``opN_<name>`` queries over the driver tables.  Nothing outside this
package imports it.
"""

import sys

from pyspark import cloudpickle

# Task functions travel inside the job: executors need the third-party
# libraries, but no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
