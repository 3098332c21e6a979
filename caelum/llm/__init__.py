"""Operations of a training-data pipeline: dedup, decontamination, scoring, tokens, archives, search.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Executors then need no copy of the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
