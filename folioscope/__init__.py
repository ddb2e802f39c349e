"""Analytics over fund portfolio disclosures, expressed as Spark plans.

Python functions of this package travel inside the plans that use them, so executors need no copy of it on
their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
