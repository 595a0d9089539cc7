"""Code-corpus analytics on Spark.

Every public function takes DataFrames and returns DataFrames. Nothing here
starts a session; see :mod:`codequarry.session` for the settings the jobs want.
"""

import sys

from pyspark import cloudpickle

# Send the few Python helpers of this package to workers by value, so that a
# cluster needs no copy of the package on its executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
