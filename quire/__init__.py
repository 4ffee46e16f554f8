"""quire: Spark-native operators for document extraction data and training corpora.

The core holds the relational operators (versions, states, reading order, packing, gates, evaluation); the optional
subpackage ``quire.llm`` holds the text operators of a training-data pipeline. The core never imports ``quire.llm``.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to the workers by value, so that a cluster needs no installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
